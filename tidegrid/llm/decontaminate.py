"""Benchmark passages in documents by SimHash of item-sized windows, in DataFrame operations only.

Words are the runs between ASCII white space, lower-cased; a shingle is ``width`` words, or the
whole item where an item has fewer. A document's window of as many words as an item is
contaminated by it where the weighted similarity of their shingles, the sum of the smaller
over the sum of the larger counts, is at least ``percent`` / 100.

1. Windows that can reach the threshold: of the m shingles on either side, at least
   ceil(2 * percent * m / (100 + percent)) must be common. Positions of shingles that occur in items of that size are found by a join with the
   items' shingles; only windows dense enough in them go on. Of each item the rarest shingles among all items are
   its anchors, so many that a window without any can't have enough of the others; a window is a candidate only
   for the items whose anchors it holds.
2. Each window and item gets a 64-bit SimHash of its shingles. Fingerprints are cut into
   ``radius + 1`` blocks; two that differ in at most ``radius`` bits agree in a block, so a join on item,
   block and its bits finds all of them, each in the first block that agrees.
3. Those within the radius are verified by the exact weighted similarity.

At similarity 0.8 fingerprints differ by 9.7 bits in the mean with a standard deviation of 2.9, so the
default radius of 22 loses a window of that similarity with a probability near 1e-5, and
a passage has several windows. Blocks that are sure to agree within such a radius have two or three bits, however long the
fingerprints (15 % of their bits differ), so blocks alone let 98 % of random pairs pass; it is the anchors that leave few.

The items' shingles are broadcast only if they number at most ``broadcast_rows``; beyond that the
join is left to shuffle.

Defined results: items of null item_id are items like others. Texts of any length are read whole. Null and empty texts, and items without words, match nothing. Items of equal text each get
their row. A repeated document row gives its matches once. Documents of null doc_id are matched as
one document. Other columns, whatever their names, are ignored by ``matches`` and returned by ``clean``.
An empty table on either side gives no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid import session

GAP = r"[\x20\x09-\x0D]+"


def _hashes(text: str = "text") -> Column:
    """The hash of each word of a text, in order."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), GAP), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(hashes: str, width: int) -> Column:
    """The hash of each run of ``width`` words; empty where there are fewer words."""
    runs = ", ".join(f"get({hashes}, i + {k})" for k in range(width))
    return F.expr(f"slice(transform({hashes}, (w, i) -> xxhash64({runs})), 1, greatest(0, size({hashes}) - {width - 1}))")


def _simhash(shingles: str) -> Column:
    """Bit b is set where more than half of the shingles' hashes have it."""
    ones = f"aggregate({shingles}, 0, (n, x) -> n + cast(shiftright(x, b) & 1 as int))"
    return F.expr(f"aggregate(sequence(0, 63), 0L, (f, b) -> if(2 * {ones} > size({shingles}), f | shiftleft(1L, b), f))")


def _common(a: str, b: str) -> str:
    """The sum of the smaller counts of each shingle of two lists."""
    plain = f"size(array_intersect({a}, {b}))"
    counted = f"aggregate(array_intersect({a}, {b}), 0, (n, s) -> n + least(size(filter({a}, x -> x = s)), size(filter({b}, x -> x = s))))"
    return f"if(size(array_distinct({a})) = size({a}) AND size(array_distinct({b})) = size({b}), {plain}, {counted})"


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each of radius + 1 blocks of 64 bits."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _block_bits(name: str, radius: int) -> Column:
    """The bits of each block of a fingerprint."""
    return F.array(*[F.expr(f"cast(shiftrightunsigned({name}, {a}) & {(1 << n) - 1}L as int)") for a, n in _blocks(radius)])


def items_of(benchmark: DataFrame, width: int) -> DataFrame:
    """Each item's shingles: item_id, w (words of a shingle), m (shingles), item_shingles, key (one for each row), print."""
    words = benchmark.select("item_id", _hashes().alias("h")).filter("size(h) > 0")
    by_width = [
        words.filter(f"size(h) {'>=' if w == width else '='} {w}").select("item_id", F.lit(w).alias("w"), _shingles("h", w).alias("item_shingles"))
        for w in range(1, width + 1)
    ]
    out = by_width[0]
    for x in by_width[1:]:
        out = out.unionByName(x)
    out = out.select("item_id", "w", F.size("item_shingles").alias("m"), "item_shingles")
    return session.written(out.withColumn("key", F.monotonically_increasing_id()).withColumn("print", _simhash("item_shingles")), "items")


def _need(percent: int) -> str:
    """The least number of m shingles on either side that are common at the threshold."""
    return f"cast(ceil({2 * percent} * m / {100 + percent}) as int)"


def anchored(items: DataFrame, percent: int) -> DataFrame:
    """w, m, shingle and the items that have it as an anchor (``anchors``), for each shingle of items of a size."""
    own = items.select("key", "w", "m", F.explode("item_shingles").alias("shingle")).groupBy("key", "w", "m", "shingle").agg(F.count(F.lit(1)).alias("times"))
    held = own.groupBy("w", "shingle").agg(F.count(F.lit(1)).alias("held")).withColumnsRenamed({"w": "_w", "shingle": "_shingle"})
    own = own.join(held, (F.col("w") == F.col("_w")) & (F.col("shingle") == F.col("_shingle")))
    # one more than the shingles of the item that a window may lack
    before = F.sum("times").over(Window.partitionBy("key", "w", "m").orderBy("held", "shingle").rowsBetween(Window.unboundedPreceding, -1))
    own = own.withColumn("anchor", F.coalesce(before, F.lit(0)) <= F.col("m") - F.expr(_need(percent)))
    return own.groupBy("w", "m", "shingle").agg(F.collect_list(F.when(F.col("anchor"), F.col("key"))).alias("anchors"))


def candidates(docs: DataFrame, items: DataFrame, width: int, percent: int, small: bool, broadcast_rows: int) -> DataFrame | None:
    """Windows that can reach the threshold: doc_id, w, m, start, items (those it can reach it with), shingles, print; written."""
    wanted = session.written(anchored(items, percent), "anchors")
    sizes = sorted(r["w"] for r in items.select("w").distinct().collect())  # at most ``width`` values
    found = None
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _hashes().alias("h"))
    for w in sizes:
        sought = wanted.filter(f"w = {w}")
        places = texts.select("doc_id", F.posexplode(_shingles("h", w)).alias("pos", "shingle"))
        hits = places.join(F.broadcast(sought) if small else sought, "shingle").select("doc_id", "w", "m", "pos", "anchors")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return None
    places = found.distinct().groupBy("doc_id", "w", "m").agg(F.sort_array(F.collect_list(F.struct("pos", "anchors"))).alias("hits")).withColumn("at", F.col("hits.pos"))
    # least number of hits in a window; i: its first hit; the window starts up to m - need before it
    need = _need(percent)
    slack = f"(m - 1 - (get(at, i + {need} - 1) - at[i]))"
    dense = F.expr(f"filter(sequence(0, size(at) - {need}), i -> {slack} >= 0)")
    starts = places.filter(f"size(at) >= {need}").select("doc_id", "w", "m", "at", "hits", F.explode(dense).alias("i"))
    # the anchors that a window may hold lie from its first hit on
    held = F.expr("flatten(transform(filter(slice(hits, i + 1, m), h -> h.pos < at[i] + m), h -> h.anchors))")
    starts = starts.select("doc_id", "w", "m", F.expr(f"sequence(greatest(0, at[i] - {slack}), at[i])").alias("starts"), F.array_distinct(held).alias("items")).filter("size(items) > 0")
    starts = starts.select("doc_id", "w", "m", F.explode("starts").alias("start"), "items").groupBy("doc_id", "w", "m", "start").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    starts = session.written(starts.groupBy("doc_id", "w").agg(F.collect_list(F.struct("m", "start", "items")).alias("windows")), "windows")

    # the texts of documents with such windows, once more
    some = starts.select("doc_id").distinct()
    count = some.limit(broadcast_rows + 1).count()
    null_safe = texts["doc_id"].eqNullSafe(some["doc_id"])
    chosen = texts.join(F.broadcast(some) if count <= broadcast_rows else some, null_safe, "left_semi").distinct()
    cut = None
    for w in sizes:
        own = starts.filter(f"w = {w}").select(F.col("doc_id").alias("d"), "windows")
        rows = chosen.select("doc_id", _shingles("h", w).alias("s"))
        rows = rows.join(own, rows["doc_id"].eqNullSafe(own["d"])).select("doc_id", "s", F.explode("windows").alias("win"))
        rows = rows.select("doc_id", F.lit(w).alias("w"), "win.m", "win.start", "win.items", F.expr("slice(s, win.start + 1, win.m)").alias("shingles"))
        cut = rows if cut is None else cut.unionByName(rows)
    out = session.written(cut.filter("size(shingles) = m").withColumn("print", _simhash("shingles")), "prints")
    session.discard(wanted)
    session.discard(starts)
    return out


def matches(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80, radius: int = 22, broadcast_rows: int = 1_000_000) -> DataFrame:
    """Best window of each contaminated document and item: doc_id, item_id, similarity, start_word, n_words, distance."""
    items = items_of(benchmark, width)
    small = (items.agg(F.sum("m")).first()[0] or 0) <= broadcast_rows
    windows = candidates(docs, items, width, percent, small, broadcast_rows)
    if windows is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, start_word int, n_words int, distance int")
    left = windows.select("doc_id", "w", "m", "start", F.explode("items").alias("item"), F.col("print").alias("own"), _block_bits("print", radius).alias("own_bits"))
    left = left.select("*", F.posexplode("own_bits").alias("block", "bits"))
    right = items.select("item_id", "key", "print", _block_bits("print", radius).alias("all_bits"))
    right = right.select("*", F.posexplode("all_bits").alias("iblock", "ibits"))
    first = "array_position(zip_with(own_bits, all_bits, (x, y) -> x = y), true) - 1"
    meet = F.expr(f"item = key AND block = iblock AND bits = ibits AND block = {first}")
    near = left.join(F.broadcast(right) if small else right, meet).select("doc_id", "w", "m", "start", "item_id", "key", F.expr("bit_count(own ^ print)").alias("distance"))
    near = near.filter(f"distance <= {radius}")
    lists = items.select("key", "item_shingles")
    near = near.join(F.broadcast(lists) if small else lists, "key")
    on = near["doc_id"].eqNullSafe(windows["doc_id"]) & (near["w"] == windows["w"]) & (near["m"] == windows["m"]) & (near["start"] == windows["start"])
    pairs = near.join(windows, on).select(near["doc_id"], near["w"], near["m"], near["start"], "item_id", "distance", "shingles", "item_shingles")
    scored = pairs.withColumn("common", F.expr(_common("shingles", "item_shingles")))
    scored = scored.filter(f"100 * common >= {percent} * (2 * m - common)").withColumn("similarity", F.expr("common / (2 * m - common)"))
    best = scored.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("minus"), (F.col("m") + F.col("w") - 1).alias("n_words"), "distance")).alias("top"))
    return best.select("doc_id", "item_id", "top.similarity", (-F.col("top.minus")).alias("start_word"), "top.n_words", "top.distance")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with its columns, that hold no benchmark passage."""
    hit = matches(docs.select("doc_id", "text"), benchmark, **options).select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_hit"]), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in the whole of ``documents``."""
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
