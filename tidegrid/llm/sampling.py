"""Bounded samples of labelled rows, counts over all rows, and what classifiers share.

Samples are taken by a hash of doc_id, so they don't depend on partitioning, and hold at most a stated number of
rows of each class (in expectation for classes above the bound). Statistics cover all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Values of a label that are broadcast at most, with a number each.
BROADCAST = 100_000


def fold(folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def balanced(rows: DataFrame, label: str, most: int, seed: int = 7) -> tuple[DataFrame, dict]:
    """About ``most`` rows at most of each value of ``label``, and the counts of all rows by value, which isn't null.

    Every value is sampled; the driver holds a count for each.
    """
    counted = rows.groupBy(F.col(label).alias("_value")).count().orderBy("_value").collect()
    counts = {r[0]: r[1] for r in counted}
    limits = [(value, int((1 << 30) * min(1.0, most / n))) for value, n in counts.items()]
    kind = rows.schema[label].dataType.simpleString()
    shares = rows.sparkSession.createDataFrame(limits, f"_value {kind}, _limit long")
    spread = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30))
    if len(limits) <= BROADCAST:
        shares = F.broadcast(shares)
    return rows.join(shares, F.col(label) == F.col("_value")).filter(spread < F.col("_limit")).drop("_value", "_limit"), counts


def document_frequencies(texts: DataFrame, counted: Callable, size: int) -> tuple[np.ndarray, int]:
    """In how many of all rows of ``texts`` each of the first ``size`` columns of ``counted`` isn't zero, and the rows' number.

    Each task sums its rows; the sums of tasks are added by column.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for block in counted(batch.column("text")):
                total[:size] += np.count_nonzero(block[:, :size], axis=0)
                total[size] += len(block)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    found = texts.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1, np.int64)
    out[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return out[:size], int(out[size])


def idf_of(frequencies: np.ndarray, rows: int) -> np.ndarray:
    return np.log((1 + rows) / (1 + frequencies)).astype(np.float32) + np.float32(1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
