"""Toxicity by a sparse logistic classifier with counterfactual regularisation.

Features of a text are the presence of hashed words and of their first four and six bytes. The model is
fitted on a bounded sample of labelled documents by accelerated proximal gradient steps on

    log loss  +  l1 * |w|  +  counterfactual * mean over swaps of (w . (x - x'))**2

where x is a sentence of a labelled document that names an identity and x' the same sentence with the term swapped for
another of its groups, each of them in turn. The last term makes the score of a sentence depend little on which identity it
names, so that neutral mentions aren't taken for insults. Features and swaps are worked out on the executors, equal swaps
are added up there. All corpus rows are scored, over their whole texts.

Defined results: null, empty and letterless texts have no features; their score is that of the bias alone. If the
labels hold fewer than two classes the score is the share of toxic labels. Null labels are ignored. A doc_id that
is labelled twice, or stands in two rows, counts twice. Texts of any length are read whole. Other columns are ignored by ``scored`` and returned by ``clean``. Rows of null
doc_id are scored, held_out is null for them and they are never learnt from. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session
from tidegrid.llm import sampling, textvec

BITS = 20
#: What a sentence ends at, and words as the features have them.
ENDS = re.compile(r"[.!?\n]+")
WORD = re.compile(r"[a-z\u0080-\U0010ffff]+")
#: Identity terms by group, as fixed values; terms of a group are swapped for each other.
IDENTITIES = (
    ("he", "she"), ("him", "her"), ("man", "woman"), ("men", "women"), ("boy", "girl"), ("gay", "straight", "lesbian"),
    ("black", "white", "asian", "latino"), ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("american", "mexican", "chinese", "indian", "african", "european"), ("old", "young"), ("deaf", "blind", "disabled"),
    ("er", "sie"), ("mann", "frau"), ("christ", "muslim", "jude"), ("il", "elle"), ("homme", "femme"), ("él", "ella"), ("hombre", "mujer"),
)
PREFIXES = (4, 6)


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII letters and the Latin-1 letters of UTF-8 in lower case."""
    data = textvec.LOWER[data]
    if len(data) > 1:
        tail = data[1:]
        upper = (data[:-1] == 0xC3) & (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)
        data[1:][upper] += 0x20
    return data


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features, not yet distinct, and their rows."""
    data = lowered(data)
    starts, ends, rows = textvec.spans(textvec.LETTER[data], offsets)
    shift = np.uint64(64 - BITS)
    found = [textvec.span_hashes(data, starts, ends)]
    for n in PREFIXES:
        found.append(textvec.mix(textvec.span_hashes(data, starts, np.minimum(ends, starts + n)) + np.uint64(n)))
    return (np.concatenate(found) >> shift).astype(np.int64), np.tile(rows, len(found))


def presence(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct features of each row."""
    for _, data, offsets in textvec.blocks(column):
        values, rows = features(data, offsets)
        both = np.unique(rows << BITS | values)
        at = np.searchsorted(both >> BITS, np.arange(len(offsets)))
        values = both & ((1 << BITS) - 1)
        for i in range(len(offsets) - 1):
            yield values[at[i] : at[i + 1]]


def others() -> dict[str, list[str]]:
    """For each identity term the terms that it is swapped for: all others of its groups."""
    out: dict[str, set[str]] = {}
    for terms in IDENTITIES:
        for term in terms:
            out.setdefault(term, set()).update(x for x in terms if x != term)
    return {term: sorted(x) for term, x in out.items()}


def sentences(text: str, terms: dict[str, list[str]]) -> Iterator[tuple[str, str]]:
    """Each sentence that names an identity, with each sentence that a swap of the term makes of it."""
    for sentence in ENDS.split(text.lower()):
        words = WORD.findall(sentence)
        for term in sorted(set(words) & terms.keys()):
            for other in terms[term]:
                yield sentence, WORD.sub(lambda m: other if m.group() == term else m.group(), sentence)  # noqa: B023


def swaps(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each sentence that names an identity and each swap: the features that the swap removes and adds."""
    terms, out = others(), []
    for text in column:
        pairs = list(sentences(text.as_py() or "", terms))
        found = presence(pa.array([x for pair in pairs for x in pair], pa.string()))
        for x, y in zip(found, found):
            out.append((np.setdiff1d(x, y, assume_unique=True), np.setdiff1d(y, x, assume_unique=True)))
    return out


def fit(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, pairs: list, l1: float = 6e-4, counterfactual: float = 1.0, steps: int = 150) -> dict:
    """Weights by feature and the bias, from features of documents and (removed, added, number) of the swaps of their sentences."""
    if len(y) == 0 or len(np.unique(y)) < 2:
        p = float(np.average(y, weights=weight)) if len(y) else 0.0
        return {"at": np.zeros(0, np.int64), "w": np.zeros(0), "bias": float(np.log((p + 1e-6) / (1 - p + 1e-6)))}
    flat = np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int32)
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in rows])
    df = np.bincount(flat, minlength=1 << BITS)
    used = np.flatnonzero(df)
    at_of = np.zeros(1 << BITS, np.int32)
    at_of[used] = np.arange(len(used))
    # features of a single document say nothing of others
    keep = df[flat] >= 3
    flat, doc = at_of[flat[keep]], doc[keep]
    d, n = len(used), len(rows)
    weight = weight / weight.sum()
    # swaps with their shares, as sparse rows of -1 and +1
    total = sum(n for _, _, n in pairs)
    place = {int(f): i for i, f in enumerate(used)}
    cols, signs, owner, share = [], [], [], []
    for k, (gone, new, count) in enumerate(pairs):
        share.append(count / total)
        for part, sign in ((gone, 1.0), (new, -1.0)):
            at = [place[int(f)] for f in part if int(f) in place]
            cols += at
            signs += [sign] * len(at)
            owner += [k] * len(at)
    cols, signs, owner, share = np.array(cols, np.int64), np.array(signs), np.array(owner, np.int64), np.array(share)
    w, bias = np.zeros(d), float(np.log((weight @ y + 1e-6) / (1 - weight @ y + 1e-6)))
    v, c, t = w.copy(), bias, 1.0
    # a diagonal that bounds the curvature: each feature has its own step, so rare words move as far as common ones
    size = np.bincount(doc, minlength=n) + 1.0
    curve = 0.25 * np.bincount(flat, (weight * size)[doc], minlength=d) + 1e-12
    if len(owner):
        curve += np.bincount(cols, (2 * counterfactual * share * np.bincount(owner, minlength=len(share)))[owner], minlength=d)
    curve_bias = 0.25 * float(weight @ size)
    last = np.inf
    for _ in range(steps):
        p = sampling.sigmoid(np.bincount(doc, v[flat], minlength=n) + c)
        loss = float(-(weight @ (y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)))) + l1 * float(np.abs(v).sum())
        if loss > last:  # too much momentum
            t = 1.0
        last = loss
        g = weight * (p - y)
        grad = np.bincount(flat, g[doc], minlength=d)
        if len(owner):
            diff = np.bincount(owner, signs * v[cols], minlength=len(share))
            grad += np.bincount(cols, (2 * counterfactual * share * diff)[owner] * signs, minlength=d)
        new = v - grad / curve
        new = np.sign(new) * np.maximum(np.abs(new) - l1 / curve, 0)
        new_bias = c - float(g.sum()) / curve_bias
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = new + (t - 1) / t_next * (new - w), new_bias + (t - 1) / t_next * (new_bias - bias)
        w, bias, t = new, new_bias, t_next
    some = np.flatnonzero(w)
    return {"at": used[some], "w": w[some], "bias": bias}


def _scorer(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        table = np.zeros(1 << BITS, np.float32)
        table[own["at"]] = own["w"]
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for first, data, offsets in textvec.blocks(batch.column("text")):
                values, rows = features(data, offsets)
                told = table[values] != 0
                both = np.unique(rows[told] << BITS | values[told])
                n = len(offsets) - 1
                scores[first : first + n] = np.bincount(both >> BITS, table[both & ((1 << BITS) - 1)], minlength=n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(sampling.sigmoid(scores + own["bias"]))], names=["doc_id", "score"])

    return run


def _featurizer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed features of each row, and a row for each swap of its sentences."""
    pack = lambda rows: pa.array([x.astype("<i4").tobytes() for x in rows], pa.binary())
    names = ["doc_id", "toxic", "features", "gone", "new"]
    for batch in batches:
        n, none = batch.num_rows, pa.nulls
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pack(presence(batch.column("text"))), none(n, pa.binary()), none(n, pa.binary())], names=names)
        for at in range(n):
            pairs = swaps(batch.column("text").slice(at, 1))
            n = len(pairs)
            yield pa.RecordBatch.from_arrays([none(n, pa.int64()), none(n, pa.int32()), none(n, pa.binary()), pack(x for x, _ in pairs), pack(x for _, x in pairs)], names=names)


def model_of(docs: DataFrame, labels: DataFrame, held_out: bool, most: int = 4000, miss: float = 4.0, counterfactual: float = 1.0) -> dict:
    """The classifier fitted on at most about ``most`` labelled documents of either class.

    With ``held_out`` rows whose crc32(doc_id as text) mod 5 is 0 are not learnt from. A toxic
    document that is missed weighs ``miss`` times as much as a false alarm; ``counterfactual`` is the weight of the term of swaps.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    if held_out:
        known = known.filter(sampling.fold(5) != 0)
    sample, counts = sampling.balanced(known, "toxic", most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the sample has at most about 2 * most rows, whatever the input
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")
    both = session.written(rows.mapInArrow(_featurizer, "doc_id long, toxic int, features binary, gone binary, new binary"), "features")
    found = both.filter("features IS NOT NULL").select("doc_id", "toxic", "features").orderBy("doc_id", "toxic", "features").toArrow()
    swapped = both.filter("features IS NULL").groupBy("gone", "new").count().orderBy("gone", "new").toArrow()
    session.discard(both)
    unpacked = lambda column: [np.frombuffer(x.as_py(), "<i4") for x in column]
    y = np.array(found.column("toxic").to_pylist(), float)
    pairs = list(zip(unpacked(swapped.column("gone")), unpacked(swapped.column("new")), swapped.column("count").to_pylist()))
    taken = {k: max(1, int((y == k).sum())) for k in counts}
    weight = np.array([(miss if k else 1.0) * counts[int(k)] / taken[int(k)] for k in y]) if len(y) else np.zeros(0)
    return fit(unpacked(found.column("features")), y, weight, pairs, counterfactual=counterfactual)


def scored(docs: DataFrame, labels: DataFrame, held_out: bool = True, most: int = 4000, counterfactual: float = 1.0) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    session.workers_see(spark)
    model = spark.sparkContext.broadcast(model_of(docs, labels, held_out, most, counterfactual=counterfactual))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(_scorer(model), "doc_id long, score double")
    return out.select("doc_id", (sampling.fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, most: int = 4000) -> DataFrame:
    """The rows of ``docs``, with its columns, that the classifier, learnt from all labels, doesn't call toxic."""
    spark = docs.sparkSession
    session.workers_see(spark)
    model = spark.sparkContext.broadcast(model_of(docs, labels, False, most))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = plain.columns[docs.columns.index("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(text)], names=["doc_id", "text"])
            (scores,) = _scorer(model)(iter([given]))
            yield batch.filter(pa.array(np.asarray(scores.column("score")) < 0.5))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of the whole of ``documents``."""
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
