"""Language by sparse multinomial logistic regression on TF-IDF of character n-grams.

N-grams are one to three characters of the lower-cased text, hashed; their document frequencies are counted over all documents that
may be learnt from. The weights are learnt from a bounded sample of
each language with follow-the-regularised-leader steps, whose elastic-net penalty sets most weights to zero. On a
part of the sample that is kept out of the steps, a temperature is fitted that calibrates the probabilities.
The driver holds the sample's counts that aren't zero; only the rows of a step are made dense.
Every value of lang is learnt, so the model grows with their number, by 32 KB each.

Defined results: null texts and texts without a letter are ``und`` with score 0. Documents of null lang or null
doc_id are not learnt from; held_out is null for a null doc_id. Where no row can be learnt from, every text is
``und``. Texts of any length are counted whole. Ties of scores go to the language first in order. Every row gives one row; other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session
from tidegrid.llm import sampling, textvec

BITS = 13


def ngram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams of one to three characters, a row for each text."""
    n = len(offsets) - 1
    code, cuts = textvec.letters(data, offsets)
    code = code.astype(np.uint64) + np.uint64(1)
    out = np.zeros(n << BITS, np.int64)
    rows = np.repeat(np.arange(n, dtype=np.int64) << BITS, np.diff(cuts))
    x = np.zeros(len(code), np.uint64)
    for k in (1, 2, 3):
        if len(code) < k:
            break
        x = (x[: len(code) - k + 1] + code[k - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        whole = rows[: len(x)] == rows[k - 1 :]
        out += np.bincount((rows[: len(x)] + (x >> np.uint64(64 - BITS)).astype(np.int64))[whole], minlength=len(out))
    return out.reshape(n, 1 << BITS).astype(np.float32)


def counted(column: pa.Array) -> Iterator[np.ndarray]:
    """N-gram counts of consecutive blocks of rows."""
    for _, data, offsets in textvec.blocks(pc.utf8_lower(column.cast(pa.large_string())), rows=128):
        yield ngram_counts(data, offsets)


class Sparse:
    """Rows of counts from packed places (uint16) and counts (uint32) of those that aren't zero; rows by number are dense."""

    def __init__(self, places: pa.Array, counts: pa.Array) -> None:
        self.places, self.counts = ([np.frombuffer(x.as_py(), kind) for x in column] for column, kind in ((places, "<u2"), (counts, "<u4")))

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), 1 << BITS), np.float32)
        for own, row in zip(out, rows):
            own[self.places[row]] = self.counts[row]
        return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(length > 0, length, 1)[:, None]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(counts: np.ndarray | Sparse, y: np.ndarray, classes: int, idf: np.ndarray, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 6, batch: int = 32) -> dict:
    """Weights, bias and temperature; a fifth of the rows only calibrates."""
    rng = np.random.Generator(np.random.PCG64(3))
    order = rng.permutation(len(y))
    held, train = order[: len(y) // 5], order[len(y) // 5 :]
    d = len(idf)
    z, n = np.zeros((d + 1, classes)), np.zeros((d + 1, classes))

    def weights() -> np.ndarray:
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    one = np.eye(classes)
    for _ in range(epochs):
        rng.shuffle(train)
        for at in range(0, len(train), batch):
            own = train[at : at + batch]
            x, w = weighted(counts[own], idf), weights()
            p = softmax(x @ w[:d] + w[d])
            g = p - one[y[own]]
            grad = np.vstack([x.T @ g, g.sum(axis=0)]) / len(own)
            sigma = (np.sqrt(n + grad**2) - np.sqrt(n)) / alpha
            z += grad - sigma * w
            n += grad**2
    w = weights()
    target, best = y[held], 1.0
    if len(held):
        logits = np.concatenate([weighted(counts[held[at : at + batch]], idf) @ w[:d] + w[d] for at in range(0, len(held), batch)])
        scale = np.exp(np.linspace(-3, 3, 121))
        loss = [-np.log(softmax(logits / t)[np.arange(len(target)), target] + 1e-12).mean() for t in scale]
        best = float(scale[int(np.argmin(loss))])
    return {"idf": idf, "w": w[:d].astype(np.float32), "bias": w[d], "temperature": best}


def _scorer(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        names = np.array(own["names"], object)
        for batch in batches:
            best, score = [], []
            for counts in counted(batch.column("text")):
                p = softmax((weighted(counts, own["idf"]) @ own["w"] + own["bias"]) / own["temperature"])
                top = p.argmax(axis=1)
                best += names[top].tolist()
                score += p[np.arange(len(p)), top].tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("letters"), pa.array(best, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "letters", "best", "p"]
            )

    return run


def _featurizer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places, counts = [], []
        for row in (row for block in counted(batch.column("text")) for row in block):
            at = np.flatnonzero(row)
            places.append(at.astype("<u2").tobytes())
            counts.append(row[at].astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(places, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "lang", "places", "counts"])


def model_of(docs: DataFrame, most: int = 600) -> dict:
    """The classifier of all values of lang, from at most about ``most`` documents of each; n-grams are counted over all that aren't held out."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").filter(sampling.fold(3) != 1)
    sample, _ = sampling.balanced(known.select("doc_id", "lang", "text"), "lang", most)
    # in an order that doesn't depend on partitioning
    found = sample.select("doc_id", "lang", "text").mapInArrow(_featurizer, "doc_id long, lang string, places binary, counts binary").orderBy("doc_id", "lang", "places", "counts").toArrow()
    langs = found.column("lang").to_pylist()
    names = sorted(set(langs))
    if not names:
        return {"names": names}
    grid = Sparse(found.column("places"), found.column("counts"))
    del found
    idf = sampling.idf_of(*sampling.document_frequencies(known, counted, 1 << BITS))
    place = {name: i for i, name in enumerate(names)}
    return fit(grid, np.array([place[x] for x in langs]), len(names), idf) | {"names": names}


def identified(docs: DataFrame, most: int = 600) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    session.workers_see(spark)
    found = model_of(docs, most)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if found["names"]:
        model = spark.sparkContext.broadcast(found)
        out = rows.select("doc_id", "text", letters).mapInArrow(_scorer(model), "doc_id long, letters boolean, best string, p double")
    else:
        out = rows.select("doc_id", F.lit(False).alias("letters"), F.lit(None).cast("string").alias("best"), F.lit(0.0).alias("p"))
    return out.select(
        "doc_id", (sampling.fold(3) == 1).alias("held_out"), F.when(F.col("letters"), F.col("best")).otherwise("und").alias("lang_pred"), F.when(F.col("letters"), F.col("p")).otherwise(0.0).alias("score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of the whole of ``documents``."""
    return identified(spark.read.parquet(f"{sf_dir}/documents.parquet"))
