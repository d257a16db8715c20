"""Contract-checked CSV scans and file checksums."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid import session
from tidegrid.contract import DatasetContract, safe_header
from tidegrid.functions.parsing import negative_text


class SchemaDrift(ValueError):
    """A file's header isn't the contract's."""


def read(spark: SparkSession, contract: DatasetContract, safe: bool = False) -> DataFrame:
    """All business columns as strings, with lineage; the contract's policy chooses the scan."""
    return ordered(spark, contract, safe) if contract.dst_policy == "ordered_pair" else strict(spark, contract)


def strict(spark: SparkSession, contract: DatasetContract) -> DataFrame:
    """Spark's own CSV scan, which splits large files; a record of more or fewer fields fails whatever columns are read."""
    reader = spark.read.option("header", True).option("sep", contract.delimiter).option("encoding", "UTF-8").option("enforceSchema", False).option("mode", "FAILFAST")
    seen = reader.csv(contract.path)
    if tuple(seen.columns) != contract.expected_columns:
        raise SchemaDrift(f"Schema drift: expected {contract.expected_columns!r}; observed {tuple(seen.columns)!r}")
    # without column pruning the parser reads every record to its end, also for queries of few columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in seen.columns])
    whole = spark.read.option("columnPruning", False).option("enforceSchema", False).option("header", True).option("sep", contract.delimiter).option("encoding", "UTF-8").option("mode", "FAILFAST").schema(schema).csv(contract.path)
    columns = [F.col(f"`{c.replace('`', '``')}`") for c in whole.columns]
    return whole.select(*columns, F.col("_metadata.file_path").alias("_source_file"), F.current_timestamp().alias("_ingested_at"))


def ordered(spark: SparkSession, contract: DatasetContract, safe: bool = False, batch: int = 10_000) -> DataFrame:
    """One task reads a file in order and numbers its records from 2; rows leave it in batches.

    Bytes come from Spark's reader, so any store that it reads will do. ``safe`` renames the columns.
    """
    session.workers_see(spark)
    headers, sep, limit = list(contract.expected_columns), contract.delimiter, contract.max_file_bytes
    names = [safe_header(h) for h in headers] if safe else headers
    if len(set(names)) != len(names) or "" in names:
        raise ValueError("safe column names collide")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("_source_row", T.LongType()), T.StructField("_source_file", T.StringType())])
    fields = [pa.field(n, pa.string()) for n in names] + [pa.field("_source_row", pa.int64()), pa.field("_source_file", pa.string())]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for path, content in zip(files.column("path").to_pylist(), files.column("content")):
                text = io.TextIOWrapper(io.BytesIO(content.as_py()), encoding="utf-8-sig", newline="")
                records = csv.reader(text, delimiter=sep, strict=True)
                if (header := next(records, [])) != headers:
                    raise ValueError(f"Schema drift: expected {headers!r}; observed {header!r}")
                rows: list[list[str]] = []
                first = 2
                for record in records:
                    if len(record) != len(headers):
                        raise ValueError(f"record {first + len(rows)} of {path} has {len(record)} fields, not {len(headers)}")
                    rows.append(record)
                    if len(rows) == batch:
                        yield packed(rows, first, path)
                        first, rows = first + batch, []
                yield packed(rows, first, path)

    def packed(rows: list[list[str]], first: int, path: str) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(len(headers))]
        columns += [pa.array(range(first, first + len(rows)), pa.int64()), pa.array([path] * len(rows), pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    files = spark.read.format("binaryFile").load(contract.path)
    if limit is not None:
        files = files.withColumn("content", F.when(F.col("length") > limit, F.raise_error(F.lit(f"file exceeds the limit of {limit} bytes"))).otherwise(F.col("content")))
    return files.select("path", "content").mapInArrow(decode, schema).withColumn("_ingested_at", F.current_timestamp())


def setup_report(spark: SparkSession, contract: DatasetContract, measure: str) -> DataFrame:
    """One row for each file: path, bytes, sha256, rows, columns, and how many values of the column ``measure`` are below zero."""
    rows = strict(spark, contract)
    negative = negative_text(F.col(f"`{measure.replace('`', '``')}`"))
    counts = rows.groupBy(F.col("_source_file").alias("_file")).agg(F.count(F.lit(1)).alias("rows"), F.count_if(negative).alias("negative"))
    files = checksums(spark, contract.path)
    same = lambda c: F.regexp_replace(F.url_decode(F.regexp_replace(c, r"\+", "%2B")), "^file:/+", "file:/")
    found = files.join(counts, same("path") == same("_file"), "left").drop("_file")
    return found.select("path", "bytes", "sha256", F.coalesce("rows", F.lit(0)).alias("rows"), F.lit(len(contract.expected_columns)).alias("columns"), F.coalesce("negative", F.lit(0)).alias("negative"))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes and sha256 of each file."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
