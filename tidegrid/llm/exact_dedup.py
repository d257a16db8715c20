"""Exact deduplication of texts by skew-safe combining, in DataFrame operations only.

Equal texts are combined in three steps, each of which groups by the whole text, so that a
digest alone never decides:

1. each task combines the equal texts it has read (the map-side part of the first aggregation);
2. what is left is merged by digest, salt and text, the salt being the input task, so that
   a group that holds a third of all rows is merged by many tasks;
3. the winners of the salts, at most one for each salt and text, are combined globally.

Rows are then sent back to their group by digest. The digests of large groups, at most ``LARGE``, are broadcast, so
that no group meets in one task here either. A digest shared by different texts is told
apart by the text itself.

Defined results: texts of any length are compared whole. Null text counts as empty; empty texts are equal to each other; texts made of
white space only are equal to one space. A null doc_id loses against any other, and a group of
null ids keeps a null ``keep_id`` and ``kept`` true. Rows that repeat a doc_id stand for one document:
each is returned, with the same values. An empty table gives an empty result. Other columns of the
input, whatever their names, are ignored by ``groups`` and returned by ``first_of_each``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session

#: A group is large if it has more than one in so many of the repeated rows; there are fewer than that.
LARGE = 10_000
WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """``text`` with every run of ASCII white space replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _rows(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    return rows.select("doc_id", "norm", F.sha2("norm", 256).alias("text_sha256"))


def winners(docs: DataFrame, salts: int = 64) -> DataFrame:
    """One row for each text: text_sha256, norm, keep_id, group_size."""
    rows = _rows(docs).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = rows.groupBy("text_sha256", "salt", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return salted.groupBy("text_sha256", "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def repeated(docs: DataFrame, salts: int = 64) -> DataFrame:
    """Digests of more than one row, as a written table: text_sha256, keep_id, group_size, n_texts."""
    by_digest = winners(docs, salts).groupBy("text_sha256").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("n_texts")
    )
    return session.written(by_digest.filter("group_size > 1"), "exact")


def _marked(docs: DataFrame, columns: list[str], salts: int) -> DataFrame:
    """``columns`` of ``docs`` with keep_id, group_size, kept and text_sha256.

    The winners have compared every text, so a digest of one text decides by itself. Rows
    whose digest stands for several texts are joined by the text as well.
    """
    found = repeated(docs, salts)
    digest = F.sha2(normalised(F.col("text")), 256)
    rows = docs.select(*columns, digest.alias("_digest"))
    plain = found.filter("n_texts = 1").select(F.col("text_sha256").alias("_digest"), F.col("keep_id").alias("_keep"), F.col("group_size").alias("_size"))
    clash = found.filter("n_texts > 1").select(F.col("text_sha256").alias("_digest"))
    if clash.isEmpty():
        total = found.agg(F.sum("group_size")).first()[0] or 0
        large = F.col("_size") > total / LARGE
        most = plain.filter(large).withColumnsRenamed({"_keep": "_large_keep", "_size": "_large_size"})
        rows = rows.join(F.broadcast(most), "_digest", "left")
        # rows of large groups are told already and are spread by doc_id
        key = F.when(F.col("_large_size").isNull(), F.col("_digest")).otherwise(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        rest = plain.filter(~large).withColumnRenamed("_digest", "_key")
        joined = rows.withColumn("_key", key).join(rest, "_key", "left")
        joined = joined.withColumn("_keep", F.coalesce("_large_keep", "_keep")).withColumn("_size", F.coalesce("_large_size", "_size"))
    else:
        texts = winners(docs, salts).withColumnsRenamed({"text_sha256": "_digest", "norm": "_norm", "keep_id": "_keep", "group_size": "_size"})
        clashing = texts.join(clash, "_digest", "left_semi").unionByName(plain.withColumn("_norm", F.lit(None).cast("string")))
        rows = docs.select(*columns, digest.alias("_digest"), normalised(F.col("text")).alias("_own"))
        on = (rows["_digest"] == clashing["_digest"]) & (clashing["_norm"].isNull() | (clashing["_norm"] == rows["_own"]))
        joined = rows.join(clashing, on, "left").drop(clashing["_digest"])
    keep = F.when(F.col("_size").isNull(), F.col("doc_id")).otherwise(F.col("_keep"))
    return joined.select(
        *columns,
        keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def groups(docs: DataFrame, salts: int = 64) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    return _marked(docs.select("doc_id", "text"), ["doc_id"], salts)


def first_of_each(docs: DataFrame, salts: int = 64) -> DataFrame:
    """The rows of ``docs``, with its columns, that stay: of equal texts that of the smallest doc_id."""
    inner = docs.toDF(*[f"c{i}_{c}" if c not in ("doc_id", "text") else c for i, c in enumerate(docs.columns)])
    kept = _marked(inner, inner.columns, salts).filter("kept")
    return kept.select(*[F.col(c).alias(d) for c, d in zip(inner.columns, docs.columns)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over the whole of ``documents``."""
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM d
"""
