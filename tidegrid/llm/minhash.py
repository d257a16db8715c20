"""Near duplicates by b-bit MinHash, with every link confirmed on the full shingle sets.

A document's set holds 64-bit hashes of its distinct word shingles. Documents of equal sets
form a class, represented by its smallest doc_id; only representatives are compared.

1. Each set gives ``LANES`` minima. Of the first ``bands * rows``, those of a band make its key; of
   all, two bits of a mix are kept, packed into longs: the sketch. (The low bits of the minima
   themselves are equal in every lane for values that agree in theirs.)
2. Representatives that share a band key are candidates. Two sketches estimate the similarity
   by counting equal lanes, corrected for lanes that are equal by chance (one in four); pairs
   estimated far below the threshold are dropped, the others are confirmed on their sets.
3. Groups are never expanded into pairs. First, each representative is compared with the
   smallest one that any of its buckets holds. Where a bucket still holds several components,
   its member of most links, the centre, is compared with those of other components.
4. Where a bucket still does, and has at most ``small`` members, these are compared by sketch, each pair in the
   first bucket that it shares. The members of a larger one are described by their difference from the centre, the
   shingles that one of both has alone. Two sets x and y differ in |dx| + |dy| - 2 |dx and dy| shingles. If the
   differences dx and dy share none, a link between x and y implies that both are linked with
   the centre; so a member that isn't links only with those whose difference shares shingles
   with its own, and at least a number of them that follows from the sizes. A prefix of each
   difference of which one must be shared is indexed, what the member has added first, since that is rare
   in a family. Those that share an indexed shingle are compared with the smallest of them, and at last, where
   components still differ and the shingles left suffice, with each other. So every pair in a
   bucket is compared, known to be connected or known to be no link, while a family of
   texts on either side of the threshold takes rows in proportion to its members.

With the defaults a pair at similarity 0.85 has no common band with a probability below 2e-6,
and the estimate drops it with a probability below 5e-5 (four standard deviations), far less above it.

Defined results: null, empty and white-space texts have an empty set, n_shingles 0 and are
linked with nothing; a document of fewer words than a shingle has one shingle, the whole
sequence. Repeated doc_ids with equal text are one document; every row is returned. Rows of null
doc_id are their own component, null. Other columns, whatever their names, are ignored by
``near_groups`` and returned by ``one_of_each``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session
from tidegrid.llm import textvec
from tidegrid.llm.components import components

LANES, LONGS = 512, 16
SIGNED = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, " + ", ".join(f"s{i} long" for i in range(LONGS))


def _signer(width: int, bands: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    rng = np.random.Generator(np.random.PCG64(977))
    factors = (rng.integers(0, 1 << 31, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
    shifts = rng.integers(0, 1 << 32, LANES, dtype=np.uint64).astype(np.uint32)
    lane = np.arange(32, dtype=np.uint64) * np.uint64(2)

    def minima(values: np.ndarray) -> np.ndarray:
        out = np.full(LANES, 0xFFFFFFFF, np.uint32)
        half = LANES // 2
        for at in range(0, len(values), 1024):
            part = values[at : at + 1024]
            low, high = (part & np.uint64(0xFFFFFFFF)).astype(np.uint32), (part >> np.uint64(32)).astype(np.uint32)
            for x, own in ((low, slice(0, half)), (high, slice(half, LANES))):
                grid = factors[own, None] * x[None, :] + shifts[own, None]
                np.minimum(out[own], grid.min(axis=1), out=out[own])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band_factors = textvec.factors(rows + 1)[1:]
        for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            n = batch.num_rows
            sizes, keys, mins = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64), np.zeros((n, LANES), np.uint32)
            for i, values in enumerate(textvec.shingle_sets(batch.column("text"), width)):
                sizes[i] = len(values)
                if len(values):
                    keys[i] = np.add.reduce(values), np.add.reduce(textvec.mix(values ^ np.uint64(0x5851F42D4C957F2D)))
                    mins[i] = minima(values)
            grid = mins[:, : bands * rows].reshape(n, bands, rows).astype(np.uint64)
            band = textvec.mix((grid * band_factors).sum(axis=2, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            flat = pa.array(band.reshape(-1).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), flat)
            packed = ((textvec.mix(mins.astype(np.uint64)) & np.uint64(3)).reshape(n, LONGS, 32) << lane).sum(axis=2, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes), *(pa.array(keys[:, i].copy().view(np.int64)) for i in (0, 1)), lists, *(pa.array(packed[:, i].copy()) for i in range(LONGS))],
                names=["doc_id", "n_shingles", "k1", "k2", "bands", *(f"s{i}" for i in range(LONGS))],
            )

    return run


def _compare(width: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keeps the pairs (a, x) and (b, y) of ids and texts whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(textvec.shingle_sets(batch.column("x"), width), textvec.shingle_sets(batch.column("y"), width))
            keep = []
            for x, y in sets:
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _chosen(texts: DataFrame, wanted: DataFrame, bits: int = 1 << 26) -> DataFrame:
    """The rows of ``texts`` whose doc_id is in ``wanted``, and few more, without a shuffle of texts.

    A bitmap of hashed ids, of at most ``bits`` / 64 rows whatever the input, is broadcast. It lets
    through all wanted rows and some others, which later joins by doc_id leave out.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {bits}) % 64 as int))")
    word = F.floor(place / 64).alias("word")
    bitmap = wanted.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("set"))
    passed = texts.select("doc_id", "text", word, bit.alias("bit")).join(F.broadcast(bitmap), "word").filter(F.col("set").bitwiseAND(F.col("bit")) != 0)
    return passed.select("doc_id", "text")


def _difference(width: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The shingles in which members (rep, y) differ from their centres (center, x), added ones first.

    Times 2 * (100 + percent), a member that isn't linked with the centre shares more than ``far`` shingles with
    a member it is linked with, and that one more than ``near``. Only places at which the first of so many can be are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(textvec.shingle_sets(batch.column("x"), width), textvec.shingle_sets(batch.column("y"), width))
            for center, rep, (x, y) in zip(batch.column("center").to_pylist(), batch.column("rep").to_pylist(), sets):
                added, missing = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
                n, differ = len(y), len(added) + len(missing)
                near = (100 + percent) * differ - (100 - percent) * (len(added) - len(missing))
                far = (100 + percent) * differ - (100 - percent) * (n + len(x))
                index = differ - near // (2 * (100 + percent))
                probe = differ - far // (2 * (100 + percent)) if far > 0 else 0
                at = np.arange(max(index, probe))
                rows = {"center": center, "rep": rep, "n": n, "differ": differ}
                columns = {k: pa.repeat(pa.scalar(v, pa.int64()), len(at)) for k, v in rows.items()}
                columns |= {"token": pa.array(np.concatenate([added, missing])[: len(at)].view(np.int64)), "at": pa.array(at), "indexed": pa.array(at < index), "probing": pa.array(at < probe)}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _differing(texts: DataFrame, around: DataFrame, width: int, percent: int) -> DataFrame:
    """center, rep, n (shingles of rep), differ, token, at, indexed, probing, written: a row for each shingle of the prefix in which rep differs from its centre."""
    wanted = around.select(F.col("center").alias("doc_id")).distinct().unionByName(around.select(F.col("rep").alias("doc_id"))).distinct()
    chosen = session.written(_chosen(texts, wanted), "texts")
    pairs = around.filter("center <> rep").join(chosen.select(F.col("doc_id").alias("center"), F.col("text").alias("x")), "center")
    pairs = pairs.join(chosen.select(F.col("doc_id").alias("rep"), F.col("text").alias("y")), "rep").select("center", "rep", "x", "y")
    rows = session.written(pairs.mapInArrow(_difference(width, percent), "center long, rep long, n long, differ long, token long, at long, indexed boolean, probing boolean"), "prefixes")
    # a shingle that one member alone has, or that none looks up, leads nowhere
    some = rows.groupBy("center", "token").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.bool_or("indexed").alias("x"), F.bool_or("probing").alias("y")).filter("low < high AND x AND y")
    out = session.written(rows.join(some.select("center", "token"), ["center", "token"], "left_semi"), "differences")
    session.discard(chosen)
    session.discard(rows)
    return out


def near_groups(docs: DataFrame, width: int = 3, percent: int = 85, bands: int = 28, rows: int = 6, small: int = 64) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * intersection >= ``percent`` * union of their sets of
    ``width``-word shingles; component_id is the smallest doc_id that links reach.
    """
    if bands * rows > LANES:
        raise ValueError(f"bands * rows must not exceed {LANES}")
    spark = docs.sparkSession
    session.workers_see(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    signed = session.written(texts.mapInArrow(_signer(width, bands, rows), SIGNED), "signed")
    sketch = [f"s{i}" for i in range(LONGS)]
    classes = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = session.written(classes, "classes")
    first = signed.join(classes.select(F.col("rep").alias("doc_id"), "k1", "k2", "n_shingles"), ["doc_id", "k1", "k2", "n_shingles"], "left_semi")
    first = session.written(first.select(F.col("doc_id").alias("rep"), "n_shingles", "bands", *sketch), "first")
    # a band key that no other representative has gives no candidate: it isn't kept
    spread = first.select("rep", F.explode("bands").alias("bucket"))
    pivots = spread.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).filter("pivot < last")
    members = session.written(spread.join(pivots.select("bucket", "pivot"), "bucket"), "buckets")
    inside = members.select("rep").distinct()
    sketches = session.written(first.join(inside, "rep", "left_semi").dropDuplicates(["rep"]), "sketches")

    # estimated share of equal lanes at the threshold, less four standard deviations
    share = percent / 100 + (1 - percent / 100) / 4
    least = int(LANES * (share - 4 * (share * (1 - share) / LANES) ** 0.5))

    def close(x: str, y: str) -> str:
        def differing(i: int) -> str:
            z = f"({x}.s{i} ^ {y}.s{i})"
            return f"bit_count(({z} | shiftrightunsigned({z}, 1)) & 6148914691236517205L)"

        differ = " + ".join(differing(i) for i in range(LONGS))
        size = f"100 * least({x}.n_shingles, {y}.n_shingles) >= {percent} * greatest({x}.n_shingles, {y}.n_shingles)"
        return f"{size} AND {LANES} - ({differ}) >= {least}"

    def estimated(pairs: DataFrame) -> DataFrame:
        x = sketches.select(F.col("rep").alias("a"), F.struct("n_shingles", *sketch).alias("x"))
        y = sketches.select(F.col("rep").alias("b"), F.struct("n_shingles", *sketch).alias("y"))
        return pairs.join(x, "a").join(y, "b").filter(close("x", "y")).select("a", "b")

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = session.written(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("doc_id")).distinct().unionByName(pairs.select(F.col("b").alias("doc_id")).distinct()).distinct()
        chosen = session.written(_chosen(texts, wanted), "texts")
        joined = pairs.join(chosen.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
        joined = joined.join(chosen.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")
        out = session.written(joined.mapInArrow(_compare(width, percent), "a long, b long").distinct(), "links")
        session.discard(chosen)
        session.discard(pairs)
        return out

    # each against the smallest member of its buckets
    stars = members.groupBy(F.col("rep").alias("b")).agg(F.min("pivot").alias("a")).filter("a <> b").select("a", "b")
    tried = session.written(estimated(stars), "tried")
    links = confirmed(tried)
    labels = components(links)
    # of a bucket of several components, the member of most links against the others
    ends = links.groupBy(F.col("a").alias("rep")).count().unionByName(links.groupBy(F.col("b").alias("rep")).count())
    degrees = ends.groupBy("rep").agg(F.sum("count").alias("degree"))
    labelled = members.select("bucket", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "rep"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("bucket")
    mixed = labelled.join(mixed, "bucket", "left_semi").join(degrees, "rep", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    mixed = session.written(mixed, "mixed")
    center = mixed.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("rep")).alias("minus"), "component")).alias("top"))
    center = center.select("bucket", (-F.col("top.minus")).alias("a"), F.col("top.component").alias("own"))
    more = mixed.join(center, "bucket").filter("component <> own").select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b"))
    more = estimated(more.distinct()).join(tried, ["a", "b"], "left_anti")
    links = links.unionByName(confirmed(more))
    labels = components(links)
    # buckets that still hold several components: small ones are crossed, each pair in the first bucket that it shares
    labelled = members.select("bucket", "rep").join(center, "bucket").select("bucket", "rep", "a")
    labelled = labelled.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    still = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("many")).filter("low < high")
    labelled = session.written(labelled.join(still.select("bucket", "many"), "bucket"), "mixed")
    # both sides of a comparison read the rows that have got their sketch once
    rest = session.written(labelled.filter(f"many <= {small}").select("bucket", "component", "rep").join(sketches, "rep"), "rest")
    shared = "x.bucket = element_at(filter(zip_with(x.bands, y.bands, (p, q) -> if(p = q, p, null)), p -> p IS NOT NULL), 1)"
    crossed = rest.alias("x").join(rest.alias("y"), F.expr(f"x.bucket = y.bucket AND x.rep < y.rep AND x.component <> y.component AND {close('x', 'y')} AND {shared}"))
    crossed = crossed.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    # members of larger ones by their difference from the centre
    around = session.written(labelled.filter(f"many > {small}").select(F.col("a").alias("center"), "rep").distinct(), "around")
    if around.isEmpty():
        links = links.unionByName(confirmed(crossed))
        labels = components(links)
    else:
        tokens = _differing(texts, around, width, percent)

        def placed() -> DataFrame:
            """center, rep, component, outside: a row for each member, with today's components; only members outside the centre's probe."""
            own = labels.select(F.col("node").alias("rep"), "component")
            held = labels.select(F.col("node").alias("center"), F.col("component").alias("home"))
            rows = around.join(own, "rep", "left").join(held, "center", "left").withColumn("component", F.coalesce("component", "rep"))
            return rows.select("center", "rep", "component", (F.col("component") != F.coalesce("home", "center")).alias("outside"))

        x = tokens.filter("probing").join(placed().filter("outside").select("center", "rep"), ["center", "rep"], "left_semi")
        y = tokens.filter("indexed").groupBy("center", "token").agg(F.min("rep").alias("a"))
        stars = x.join(y, ["center", "token"]).groupBy(F.col("rep").alias("b"), "center").agg(F.min("a").alias("a")).filter("a <> b")
        stars = estimated(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        links = links.unionByName(confirmed(crossed.unionByName(stars).distinct()))
        labels = components(links)
        # components and sketches come to members first, then once to the shingles that are still probed or indexed
        told = tokens.join(placed().join(sketches.select("rep", *sketch, "n_shingles"), "rep"), ["center", "rep"])
        held = session.written(told.withColumn("probing", F.expr("probing AND outside")).filter("probing OR indexed").drop("outside"), "held")
        x, y = held.filter("probing").alias("x"), held.filter("indexed").alias("y")
        # the shingles that both must share, times 2 * (100 + percent), and those that are left from here on
        needed = f"({100 + percent} * (x.differ + y.differ) - {100 - percent} * (x.n + y.n))"
        left = f"{2 * (100 + percent)} * least(x.differ - x.at, y.differ - y.at)"
        far = x.join(y, F.expr(f"x.center = y.center AND x.token = y.token AND x.component <> y.component AND {left} >= {needed} AND {close('x', 'y')}"))
        far = far.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
        links = links.unionByName(confirmed(far))
        labels = components(links)
        session.discard(tokens)
        session.discard(held)
    for table in (first, members, sketches, tried, mixed, labelled, rest, around):
        session.discard(table)
    return _assigned(signed, classes, labels)


def _assigned(signed: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with the component of their class; only classes that say more than the row itself are joined."""
    told = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").filter("n > 1 OR component IS NOT NULL")
    told = told.select("k1", "k2", "n_shingles", F.coalesce("component", "rep").alias("component"))
    rows = signed.select("doc_id", "n_shingles", "k1", "k2").join(told, ["k1", "k2", "n_shingles"], "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"), own.eqNullSafe(F.col("doc_id")).alias("kept"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = 32, rows: int = 5) -> DataFrame:
    """The rows of ``docs``, with its columns, of which each component keeps its smallest doc_id."""
    gone = near_groups(docs, width, percent, bands, rows).filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates over the whole of ``documents``."""
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS shingles
  FROM w
), spread AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM spread a JOIN spread b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other
), lowest AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, len(shingles) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN lowest USING (doc_id)
"""
