"""Near-equal lines by a segment-partition edit join.

Two lines are linked if at most ``edits`` character edits turn one into the other. Cut one line into edits + 1
segments: of these, one occurs unchanged in the other, near its place. So

1. equal lines form a class, represented by the occurrence of smallest (doc_id, line_no);
2. each representative is indexed by its length and its segments, and probes the indexes of its own and of
   slightly smaller lengths with those of its substrings whose place fits (multi-match-aware selection);
3. within a key, pairs pass a signature test that loses none: the parity of hashed letter pairs differs
   in at most 4 * edits bits, of 64 where one line alone is indexed, and of 256 then;
4. the others are verified by banded bit-parallel edit distance, each pair in the first key that it shares.

Every link between different lines is found and counted. A family of n near-equal lines has up to n * (n - 1) / 2 of
them, so they are not listed: a key is compared as a whole in one task, which returns for each of its lines the number of links
and of the links a spanning forest. Thus rows are in proportion to the lines, while time follows the number of links. A key of more than
``small`` lines, several of them indexed, takes a further step: lines that share a segment where an alignment keeps it are linked only
if what is left of them without it is within the same number of edits, so what is left is cut into segments again, and so on up to
``levels`` times; after the last, such keys are compared in parts of about ``small`` lines with all that is indexed.
The result has the component and the number of links of each line, and links that connect the components.

Defined results: lines are cut at line feeds; null and empty texts have no lines, blank lines (ASCII white space only)
are left out. Lines of all lengths are linked: where a line has fewer than edits + 1 characters its first
segment is empty, so it meets every line of a fitting length. A line may be as long as its text; keys and
verification then take time in proportion to it. Rows that repeat
a doc_id count as occurrences of equal place. Null doc_ids come last in the order of occurrences. Other columns are ignored by
``related`` and returned by ``cleaned``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session
from tidegrid.llm import textvec
from tidegrid.llm.components import components

#: Bit of a mark.
OWN = 1
#: Longs of the wider signature.
WIDE = 4
BLANK = r"^[\x20\x09-\x0D]*\z"


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of edits + 1 segments of nearly equal size."""
    n = edits + 1
    cuts = [length * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def lookups(edits: int) -> list[tuple[int, int, int]]:
    """(characters more than the indexed line has, segment, shift of its place) of each substring that a line looks up."""
    out = []
    for more in range(edits + 1):
        for i in range(edits + 1):
            low, high = max(-i, more - (edits - i)), min(i, more + edits - i)
            out += [(more, i, shift) for shift in range(low, high + 1)]
    return out


def probes(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    """(indexed length, segment, start, size) of each substring that a line of ``length`` looks up."""
    out = []
    for more, i, shift in lookups(edits):
        if more <= length:
            start, size = segments(length - more, edits)[i]
            if 0 <= start + shift <= length - size:
                out.append((length - more, i, start + shift, size))
    return out


def within(a: str, b: str, most: int) -> int | None:
    """The edit distance of two strings if it is at most ``most``: bit-parallel, in a band of 2 * most + 2 rows."""
    if a == b:
        return 0
    start, n = 0, min(len(a), len(b))
    while start < n and a[start] == b[start]:
        start += 1
    end = 0
    while end < n - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return None
    if not b or len(a) <= most:
        return _small(a, b, most)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    width = 2 * most + 2
    mask = (1 << width) - 1
    diagonal, across = 1 << width - 1, 1 << width - 2
    plus, minus = mask ^ (1 << most + 1) - 1, 0
    distance, first = most, most + 1 - width
    for i, c in enumerate(b):
        own = places.get(c, 0)
        match = (own >> first if first >= 0 else own << -first) & mask
        zero = ((((match & plus) + plus) ^ plus) | match | minus) & mask
        up = (minus | ~(zero | plus)) & mask
        down = zero & plus
        if i < len(a) - most:
            distance += not zero & diagonal
        else:
            distance += bool(up & across) - bool(down & across)
            across >>= 1
        plus = (down | ~((zero >> 1) | up)) & mask
        minus = up & (zero >> 1)
        first += 1
    return distance if distance <= most else None


def _small(a: str, b: str, most: int) -> int | None:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] if row[-1] <= most else None


STEP, BACK = np.uint64(0xD1342543DE82EF95), np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def _keys(edits: int, index: bool, carry: tuple[str, ...] = ()) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keys of lines (base, lid, print, line): of their segments (``index``) or of all that they look up.

    ``mark`` of what a line looks up: its place in ``lookups`` and whether the line is indexed by it too, as bits from the second on and first.
    The columns of ``carry`` are returned too.
    Substrings are hashed by differences of running sums; texts whose hashes clash are told apart when pairs are verified.
    """
    sought = [(0, i, 0) for i in range(edits + 1)] if index else lookups(edits)
    n_segments = edits + 1

    def powers(step: np.uint64, n: int) -> np.ndarray:
        out = np.full(n, step, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = powers(STEP, 4096), powers(BACK, 4096)
        for batch in batches:
            bases = batch.column("base").to_numpy(zero_copy_only=False).view(np.uint64)
            for first, data, offsets in textvec.blocks(batch.column("line")):
                code, cuts = textvec.letters(data, offsets)
                starts, length = cuts[:-1], np.diff(cuts)
                if len(up) <= (longest := int(length.max(initial=0))):
                    up, down = powers(STEP, 2 * longest), powers(BACK, 2 * longest)
                place = np.arange(len(code)) - np.repeat(starts, length)
                sums = np.zeros(len(code) + 1, np.uint64)
                np.cumsum(textvec.mix(code.astype(np.uint64) + np.uint64(1)) * up[place], out=sums[1:])
                base = bases[first : first + len(length)]
                for k, (more, i, shift) in enumerate(sought):
                    other = length - more
                    start = other * i // n_segments
                    size, at = other * (i + 1) // n_segments - start, start + shift
                    rows = np.flatnonzero((other >= 0) & (at >= 0) & (at + size <= length))
                    at, size, other = at[rows], size[rows], other[rows]
                    low = starts[rows] + at
                    own = (sums[low + size] - sums[low]) * down[at]
                    key = textvec.mix(own + textvec.mix(base[rows] * STEP + (other << 8 | i).astype(np.uint64)))
                    take = pa.array(rows + first)
                    columns = {"key": pa.array(key.view(np.int64)), "lid": batch.column("lid").take(take), "print": batch.column("print").take(take)}
                    if not index:
                        columns["mark"] = pa.array(np.full(len(rows), k << 1 | (more == 0 and shift == 0), np.int32))
                    columns |= {c: batch.column(c).take(take) for c in carry}
                    yield pa.RecordBatch.from_pydict(columns)

    return run


def _left(edits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines without the part that their mark stands for."""
    sought = lookups(edits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for mark, line in zip(batch.column("mark").to_pylist(), batch.column("line")):
                line = line.as_py()
                more, i, shift = sought[mark >> 1]
                at, size = segments(len(line) - more, edits)[i]
                out.append(line[: at + shift] + line[at + shift + size :])
            yield batch.drop_columns(["mark", "line"]).append_column("line", pa.array(out, pa.string()))

    return run


def _prints(longs: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the parity of letter pairs, hashed to 64 bits in each of ``longs`` (a power of two) columns: print, print1 and so on."""
    bits = 6 + longs.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros((0, longs), np.int64)]
            for _, data, offsets in textvec.blocks(batch.column("line")):
                code, cuts = textvec.letters(data, offsets)
                code = code.astype(np.uint64)
                pairs = ((code[:-1] << np.uint64(21) | code[1:]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
                n = len(cuts) - 1
                row = np.repeat(np.arange(n), np.diff(cuts))
                whole = row[:-1] == row[1:]
                odd = np.bincount(row[:-1][whole] << bits | pairs[whole].astype(np.int64), minlength=n << bits) & 1
                out.append(np.packbits(odd.reshape(n, 64 * longs).astype(np.uint8), axis=1).view(">u8").reshape(n, longs).astype(np.uint64).view(np.int64))
            grid = np.concatenate(out)
            names = ["print", *(f"print{i}" for i in range(1, longs))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(grid[:, i].copy()) for i in range(longs))], names=[*batch.schema.names, *names])

    return run


def first_key(x: str, y: str, edits: int, large: frozenset[int] | set[int] = frozenset(), path: int = 0) -> int | None:
    """The path of the first key in which ``x`` is indexed, ``y`` (no shorter) looks it up and both are compared.

    The path of a key is that of the key before it, times edits + 2, plus its segment plus 1. Lines that meet in a ``large`` key are
    compared in those of what is left of them, and there only if they share no other.
    """
    shared, more = [], len(y) - len(x)
    for i, (start, size) in enumerate(segments(len(x), edits)):
        own, further = x[start : start + size], path * (edits + 2) + i + 1
        low, high = max(-i, more - (edits - i), -start), min(i, more + edits - i, len(y) - size - start)
        places = [start + shift for shift in range(low, high + 1) if y[start + shift : start + shift + size] == own]
        if places and further not in large:
            return further
        shared.append((start, size, further, places))
    for start, size, further, places in shared:
        for at in places:
            found = first_key(x[:start] + x[start + size :], y[:at] + y[at + size :], edits, large, further)
            if found is not None:
                return found
    return None


#: Columns of what ``_linker`` reads, sorted by the first two.
MET = ["key", "part", "path", "lid", "line", "own", "probing", "large", "print", *(f"print{i}" for i in range(1, WIDE))]
LINKED = "a long, b long, distance int, n long"


def _linker(edits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of the lines of each key, the number of links (a, n) and links (a, b, distance) that connect those that links connect."""

    def linked(rows: list[tuple]) -> list[tuple]:
        x, y = list({r[3]: r for r in rows if r[5]}.values()), list({r[3]: r for r in rows if r[6]}.values())
        out, counts, root = [], dict.fromkeys((r[3] for r in rows), 0), {}

        def find(a: int) -> int:
            while (up := root.get(a, a)) != a:
                root[a] = a = root.get(up, up)
            return a

        if not x or not y:
            return out
        signs = np.array([r[8:] for r in y], np.int64).view(np.uint64)
        step = max(1, (1 << 18) // len(y))
        for at in range(0, len(x), step):
            own = np.array([r[8:] for r in x[at : at + step]], np.int64).view(np.uint64)
            differ = np.bitwise_count(own[:, None, :] ^ signs[None, :, :]).sum(axis=2, dtype=np.int32)
            for i, j in zip(*(k.tolist() for k in np.nonzero(differ <= 4 * edits))):
                (_, _, path, a, p, _, _, large, *_), (_, _, _, b, q, *_) = x[at + i], y[j]
                if a == b or len(p) == len(q) and a > b or first_key(p, q, edits, set(large or ())) != path:
                    continue
                if (distance := within(p, q, edits)) is None:
                    continue
                counts[a] += 1
                counts[b] += 1
                low, high = sorted((find(a), find(b)))
                if low != high:
                    root[high] = low
                    out.append((min(a, b), max(a, b), distance, None))
        return out + [(a, None, None, n) for a, n in counts.items() if n]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("distance", pa.int32()), ("n", pa.int64())])
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in MET)))
        for _, met in groupby(rows, itemgetter(0, 1)):
            if found := linked(list(met)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), schema.types)], schema=schema)

    return run


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, line_no and line of each line that isn't blank."""
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.col("text"), "\n")).alias("line_no", "line"))
    return cut.filter(~F.col("line").rlike(BLANK))


def _digest(line: str = "line") -> Column:
    return F.substring(F.unhex(F.sha2(line, 256)), 1, 16).alias("digest")


def classes_of(docs: DataFrame) -> DataFrame:
    """One row for each different line, written: lid, doc_id, line_no, line, n, print."""
    # a place is one number, doc_id * 2**31 + line_no, and those of null doc_id come last: so it is kept in a hash aggregate
    one = "cast(2147483648 as decimal(38, 0))"
    last = f"cast(4611686018427387904 as decimal(38, 0)) * {one} * 4"
    place = F.expr(f"cast(coalesce(cast(doc_id as decimal(20, 0)) * cast(2147483648 as decimal(11, 0)), {last}) as decimal(38, 0)) + line_no").cast("decimal(38,0)")
    found = lines_of(docs).select("line", place.alias("place")).groupBy("line").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"))
    found = found.withColumn("line_no", F.expr(f"pmod(place, {one})").cast("int"))
    doc_id = F.when(F.expr(f"place < {last}"), F.expr(f"(place - line_no) div {one}")).cast("long")
    found = found.select(F.monotonically_increasing_id().alias("lid"), doc_id.alias("doc_id"), "line_no", "line", "n")
    return session.written(found.mapInArrow(_prints(1), "lid long, doc_id long, line_no int, line string, n long, print long"), "lines")


def links_of(classes: DataFrame, edits: int = 2, small: int = 1024, levels: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (a, b, distance) between the ids of different lines that connect all lines within ``edits``, (node, component) of these and (lid, n_links): all links of each."""
    lines = classes.select(F.lit(0).cast("long").alias("base"), "lid", "print", "line")
    segment = f"element_at(array({', '.join(str(i + 1) for _, i, _ in lookups(edits))}), shiftright(mark, 1) + 1)"
    columns = ["print", *(f"print{i}" for i in range(1, WIDE))]
    large, found = None, []

    for level in range(levels):
        own, path = (f"own AND mark & {OWN} <> 0", f"path * {edits + 2} + {segment}") if level else (f"mark & {OWN} <> 0", segment)
        carry, carried = (("own", "path", "line"), ", own boolean, path int, line string") if level else ((), "")
        index = (lines.filter("own") if level else lines).mapInArrow(_keys(edits, True), "key long, lid long, print long")
        # where one line alone is indexed its signature is the combination of all
        pivots = index.groupBy("key").agg(F.min("lid").alias("pivot"), F.bit_xor("print").alias("sole"), F.count(F.lit(1)).alias("n"))
        probe = lines.mapInArrow(_keys(edits, False, carry), "key long, lid long, print long, mark int" + carried)
        # and then nothing is left to compare but with it
        met = probe.join(pivots, "key").filter(f"n > 1 OR lid <> pivot AND bit_count(print ^ sole) <= {4 * edits}")
        met = session.written(met.selectExpr("key", "lid", "print", "mark", *carry[2:], "pivot", "n", f"{own} AS own", f"{path} AS path"), "members")
        several = met.groupBy("key").agg(F.count(F.lit(1)).alias("many"))
        rows = met.join(several, "key")
        again = f"n > 1 AND many > {small}" if level < levels - 1 else "false"
        more = rows.filter(again)
        if last := level == levels - 1 or more.isEmpty():
            again = "false"
        else:
            more = session.written(more, "large")
            known = more.filter("own").select("lid", "path")
            large = known if large is None else large.unionByName(known)
        rows = rows.filter(f"NOT ({again})").select("key", "lid", "own", "path", "pivot", "n", "many")
        alone = rows.filter("n = 1").select("key", F.col("pivot").alias("lid"), F.lit(True).alias("own"), "path", "many").distinct()
        rows = rows.drop("pivot", "n").unionByName(alone)
        parts = f"cast((many + {small - 1}) div {small} as int)"
        rows = rows.withColumn("home", F.expr(f"cast(pmod(xxhash64(lid), {parts}) as int)"))
        rows = rows.withColumn("part", F.explode(F.expr(f"if(own, sequence(0, {parts} - 1), array(home))"))).withColumn("probing", F.expr("part = home"))
        rows = session.written(rows.drop("home", "many"), "parts")  # so that its size is known to the joins
        texts = classes.select("lid", "line").join(rows.select("lid").distinct(), "lid", "left_semi")
        texts = session.written(texts.mapInArrow(_prints(WIDE), "lid long, line string, " + ", ".join(f"{c} long" for c in columns)), "ends")
        whole = rows.join(texts, "lid")
        if large is None:
            whole = whole.withColumn("large", F.lit(None).cast("array<int>"))
        else:
            whole = whole.join(large.groupBy("lid").agg(F.collect_set("path").alias("large")), "lid", "left")
        whole = whole.select(*MET).repartition("key", "part").sortWithinPartitions("key", "part")
        found.append(session.written(whole.mapInArrow(_linker(edits), LINKED), "links"))
        for table in (texts, rows, met):
            session.discard(table)
        if last:
            break
        left = more.withColumnRenamed("key", "base")
        left = left if level else left.join(classes.select("lid", "line"), "lid")
        lines = session.written(left.select("base", "lid", "print", "own", "path", "mark", "line").mapInArrow(_left(edits), "base long, lid long, print long, own boolean, path int, line string"), "left")
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    links = out.filter("b IS NOT NULL").select("a", "b", "distance")
    return links, components(links), out.filter("b IS NULL").groupBy(F.col("a").alias("lid")).agg(F.sum("n").alias("n_links"))


def related(docs: DataFrame, edits: int = 2) -> DataFrame:
    """Links between different lines, by their representatives, and the membership of each line.

    relation ``member``, one row for each line: it is equal to that of (to_doc, to_line), which represents it, and
    (class_doc, class_line) is the smallest place of all lines that links connect with it. relation ``link``: (doc_id, line_no)
    and (to_doc, to_line) represent different lines ``distance`` edits apart, smaller place first; the links
    are verified ones that connect every class, not all of its pairs. All are counted: ``n_links`` of a member is the number of
    different lines within ``edits`` of it, copies counted once; of a link it is null.
    """
    session.workers_see(docs.sparkSession)
    classes = classes_of(docs)
    links, labels, counts = links_of(classes, edits)
    place = classes.select("lid", F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "line_no").alias("at"))
    placed = labels.join(counts.withColumnRenamed("lid", "node"), "node").join(place.withColumnRenamed("lid", "node"), "node")
    firsts = placed.groupBy("component").agg(F.min("at").alias("first"))
    placed = session.written(placed.join(firsts, "component").select("node", "at", "first", "n_links"), "placed")
    x, y = placed.select(F.col("node").alias("a"), F.col("at").alias("x"), "first"), placed.select(F.col("node").alias("b"), F.col("at").alias("y"))
    ends = links.join(x, "a").join(y, "b").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "distance", "first").distinct()
    out = ends.select(
        F.lit("link").alias("relation"), "x.doc_id", "x.line_no", F.col("y.doc_id").alias("to_doc"), F.col("y.line_no").alias("to_line"), "distance",
        F.col("first.doc_id").alias("class_doc"), F.col("first.line_no").alias("class_line"), F.lit(None).cast("long").alias("n_links"),
    )
    many = classes.join(placed.select(F.col("node").alias("lid"), "first", "n_links"), "lid", "left").filter("n > 1 OR first IS NOT NULL")
    many = many.select(_digest(), F.col("doc_id").alias("to_doc"), F.col("line_no").alias("to_line"), "first", "n_links", "n")
    members = lines_of(docs).select("doc_id", "line_no", _digest()).join(many, "digest", "left")
    own, alone = F.col("n").isNull(), F.col("first").isNull()
    to_doc, to_line = F.when(own, F.col("doc_id")).otherwise(F.col("to_doc")), F.when(own, F.col("line_no")).otherwise(F.col("to_line"))
    members = members.select(
        F.lit("member").alias("relation"), "doc_id", "line_no", to_doc.alias("to_doc"), to_line.alias("to_line"), F.lit(0).alias("distance"),
        F.when(alone, to_doc).otherwise(F.col("first.doc_id")).alias("class_doc"), F.when(alone, to_line).otherwise(F.col("first.line_no")).alias("class_line"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    return out.unionByName(members)


def cleaned(docs: DataFrame, edits: int = 2) -> DataFrame:
    """``docs`` with its columns, the text without lines that a smaller place holds already, equal or linked.

    Of lines that links connect, the one of the smallest place stays. Blank lines
    stay. Needs one row for each doc_id.
    """
    later = related(docs, edits).filter("relation = 'member' AND NOT (doc_id <=> class_doc AND line_no = class_line)")
    drop = later.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("line_no").alias("_drop"))
    inner = docs.toDF(*[f"c{i}_{c}" if c not in ("doc_id", "text") else c for i, c in enumerate(docs.columns)])
    kept = F.expr("array_join(filter(split(text, '\\n'), (x, i) -> NOT array_contains(_drop, i)), '\\n')")
    text = F.when(F.col("_drop").isNull(), F.col("text")).otherwise(kept)
    out = inner.join(drop, inner["doc_id"].eqNullSafe(drop["_id"]), "left").withColumn("text", text)
    return out.select(*[F.col(c).alias(d) for c, d in zip(inner.columns, docs.columns)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-equal lines of the whole of ``documents``."""
    return related(spark.read.parquet(f"{sf_dir}/documents.parquet"))
