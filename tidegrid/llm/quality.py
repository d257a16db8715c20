"""Quality by voting of nearest neighbours in a latent semantic space.

A text is the TF-IDF vector of its hashed byte trigrams, whose document frequencies are counted over all documents, with the shares of words
that repeat one of the ``LAGS`` last words beside it (a feature chosen after a look at errors on generated tables), projected on
the leading singular vectors of a bounded sample of labelled documents. The labelled vectors are broadcast: their number is a parameter, so their size has
a bound. Every document's cosine with every labelled vector is computed exactly, block by block, and the
labels of the nearest neighbours vote with weights that fall with distance. Classes are sampled alike, so votes are
weighted back to the classes' true shares. All vectors tied with the last of the ``neighbours`` nearest vote.

Defined results: null and empty texts, which have no trigrams, score the share of good labels. If there are no labels the
score is 0.5. Texts of any length are counted whole. A doc_id that is labelled twice, or stands in two rows, counts twice. Null labels and null doc_ids are not learnt from; held_out is null for a null doc_id. Every row
gives one row; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session
from tidegrid.llm import sampling, textvec

BUCKETS = 4096
DIMENSIONS = 64
LAGS = 2
#: Cosines so close are tied: single precision tells no more.
TIE = np.float32(1e-5)
#: Shares are held as counts in a million.
SHARE = 1_000_000


def trigram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed byte trigrams and the shares of repeated words, a row for each text."""
    n = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((n, BUCKETS + LAGS), np.float32)
    x = data.astype(np.uint32)
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    code = (code * np.uint32(2654435769)) >> np.uint32(20)
    sizes = np.diff(offsets)
    rows = np.repeat(np.arange(n, dtype=np.int64), sizes)
    same = rows[:-2] == rows[2:]
    flat = (rows[:-2] * BUCKETS + code)[same]
    counts = np.bincount(flat, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)
    starts, ends, owner = textvec.spans(~textvec.WHITE[data], offsets)
    words = textvec.span_hashes(data, starts, ends)
    total = np.maximum(np.bincount(owner, minlength=n), 1)
    shares = [SHARE * np.bincount(owner[k:][(words[k:] == words[:-k]) & (owner[k:] == owner[:-k])], minlength=n) / total for k in range(1, LAGS + 1)]
    return np.column_stack([counts, *shares]).astype(np.float32)


def counted(column: pa.Array) -> Iterator[np.ndarray]:
    """Trigram counts of consecutive blocks of rows."""
    for _, data, offsets in textvec.blocks(column, rows=256):
        yield trigram_counts(data, offsets)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of unit length and the shares; rows without trigrams stay zero."""
    x = np.log1p(counts)
    x[:, :BUCKETS] *= idf
    x[:, BUCKETS:] = 0
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    x /= np.where(length > 0, length, 1)[:, None]
    x[:, BUCKETS:] = counts[:, BUCKETS:] / SHARE
    return x


def unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1)
    return (x / np.where(length > 0, length, 1)[:, None]).astype(np.float32)


def fit(counts: np.ndarray, y: np.ndarray, shares: dict[int, float], idf: np.ndarray) -> dict:
    """Projection and the labelled vectors with the weights of their votes."""
    x = weighted(counts, idf)
    rng = np.random.Generator(np.random.PCG64(11))
    k = min(DIMENSIONS, *x.shape)
    # randomised range finder with three power steps
    q = np.linalg.qr(x.T @ (x @ rng.standard_normal((x.shape[1], k + 16)).astype(np.float32)))[0]
    for _ in range(3):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ vt[:k].T).astype(np.float32)
    of = {c: max(1, int((y == c).sum())) for c in shares}
    vote = np.array([shares[int(c)] * len(y) / of[int(c)] for c in y], np.float32)
    return {"idf": idf, "basis": basis, "vectors": unit(x @ basis), "y": y.astype(np.float32), "vote": vote, "prior": float(shares.get(1, 0.0))}


def vote(model: dict, counts: np.ndarray, neighbours: int = 15, sharpness: float = 8.0) -> np.ndarray:
    """The score of each row of counts: weighted votes of its nearest labelled vectors, with all that are as near as the last."""
    if not len(model["y"]):
        return np.full(len(counts), model["prior"])
    points = unit(weighted(counts, model["idf"]) @ model["basis"])
    cosine = points @ model["vectors"].T
    k = min(neighbours, cosine.shape[1])
    last = np.partition(cosine, -k, axis=1)[:, -k]
    row, near = np.nonzero(cosine >= last[:, None] - TIE)
    weight = np.exp(sharpness * cosine[row, near]) * model["vote"][near]
    score = np.bincount(row, weight * model["y"][near], len(cosine)) / np.bincount(row, weight, len(cosine))
    return np.where(counts.any(axis=1), np.clip(score, 0, 1), model["prior"]).astype(float)


def _scorer(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            scores = np.concatenate([*(vote(own, x) for x in counted(batch.column("text"))), np.zeros(0)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def _featurizer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [row.astype("<u4").tobytes() for block in counted(batch.column("text")) for row in block]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality").cast(pa.int32()), pa.array(packed, pa.binary())], names=["doc_id", "quality", "counts"])


def model_of(docs: DataFrame, labels: DataFrame, most: int = 1500) -> dict:
    """The labelled vectors of at most about ``most`` documents of either class, none held out; trigrams are counted over all documents."""
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    sample, counts = sampling.balanced(known.filter(sampling.fold(5) != 0), "quality", most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the sample has at most about 2 * most rows, whatever the input
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")
    # in an order that doesn't depend on partitioning
    found = rows.mapInArrow(_featurizer, "doc_id long, quality int, counts binary").orderBy("doc_id", "quality", "counts").toArrow()
    y = np.array(found.column("quality").to_pylist(), int)
    total = sum(counts.values())
    if not len(y):
        return {"y": y, "prior": counts.get(1, 0) / total if total else 0.5}
    grid = np.stack([np.frombuffer(x.as_py(), "<u4") for x in found.column("counts")]).astype(np.float32)
    return fit(grid, y, {c: n / total for c, n in counts.items()}, sampling.idf_of(*sampling.document_frequencies(texts, counted, BUCKETS)))


def scored(docs: DataFrame, labels: DataFrame, most: int = 1500) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted."""
    spark = docs.sparkSession
    session.workers_see(spark)
    model = spark.sparkContext.broadcast(model_of(docs, labels, most))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(_scorer(model), "doc_id long, score double")
    return out.select("doc_id", (sampling.fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of the whole of ``documents``."""
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
