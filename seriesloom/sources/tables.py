"""Stored tables. Every rewrite is staged first, and replaces only the partitions it touches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from seriesloom import schemas
from seriesloom.operators import bitemporal
from seriesloom.session import cut_lineage, discard, scratch_path

BUCKETS = 64
BUCKET_COLUMN = "bucket_of_{}"


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


@contextmanager
def _staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Write once below the shared folder and read the files back; the copy goes when the block succeeds."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    yield spark.read.schema(df.schema).parquet(path)
    discard(spark, path)


def _balanced(df: DataFrame, column: str) -> DataFrame:
    """Rows of one partition value together, but large values split and small ones merged by size."""
    return df.hint("rebalance", column)


def _replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Overwrite only the partitions present in ``df``; the source may be read from ``path``."""
    with _staged(df, "replace") as staged:
        _balanced(staged, column).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


# --- series files -------------------------------------------------------------------------

def write_series_files(obs: DataFrame, path: str) -> None:
    """One JSON array per series, rows in day order."""
    record = F.struct(F.col("as_of").cast("string").alias("as_of"), "value", F.lit("vendor").alias("source"))
    (obs.groupBy("series_id").agg(F.to_json(F.array_sort(F.collect_list(record)), {"ignoreNullFields": "false"}).alias("text"))
     .write.mode("overwrite").partitionBy("series_id").text(path))


def read_series_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the stored JSON arrays, missing values dropped."""
    schema = StructType([*schemas.SERIES_FILE.fields, StructField("series_id", StringType())])
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.filter(F.col("value").isNotNull()).select("series_id", F.to_date("as_of").alias("as_of"), "value", "source")


def write_series_lines(obs: DataFrame, path: str) -> None:
    """Many series per file, one row a line, in series and day order; a long series spans several files."""
    rows = obs.select("series_id", F.col("as_of").cast("string").alias("as_of"), "value", F.lit("vendor").alias("source"))
    (rows.repartitionByRange("series_id", "as_of").sortWithinPartitions("series_id", "as_of")
     .write.mode("overwrite").json(path, ignoreNullFields=False))


def read_series_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the stored lines, missing values dropped; files are split at any line."""
    schema = StructType([StructField("series_id", StringType()), *schemas.SERIES_FILE.fields])
    rows = spark.read.schema(schema).json(path)
    return rows.filter(F.col("value").isNotNull()).select("series_id", F.to_date("as_of").alias("as_of"), "value", "source")


def export_slot(obs: DataFrame, path: str) -> None:
    """Stored series as hand-editable rows, sorted by series and day."""
    (obs.select("series_id", F.col("as_of").cast("string").alias("as_of"), F.col("value").cast("string").alias("value"))
     .orderBy("series_id", "as_of").write.mode("overwrite").json(path))


# --- full-replace table ---------------------------------------------------------------------

def stored_buckets(held: DataFrame) -> int:
    """The number of buckets a stored table was written with; its partition column names it."""
    prefix = BUCKET_COLUMN.format("")
    return next(int(name.removeprefix(prefix)) for name in held.columns if name.startswith(prefix))


def replace_series(obs: DataFrame, path: str, buckets: int | None = None) -> None:
    """Replace the whole history of each series in ``obs``; other series keep theirs.

    Series live in hash buckets, so a million series do not become a million folders;
    only the buckets of the touched series are rewritten. The first write sets their number
    (``BUCKETS`` unless given; choose it for the table's final size), and it is stored with the table:
    later writes use it, and one that asks for another number is refused.
    """
    held = _read_or_none(obs.sparkSession, path)
    if held is not None:
        stored = stored_buckets(held)
        if buckets is not None and buckets != stored:
            raise ValueError(f"the table at {path} has {stored} buckets, not {buckets}")
        buckets = stored
    buckets = buckets or BUCKETS
    column = BUCKET_COLUMN.format(buckets)
    fresh = obs.withColumn(column, F.pmod(F.xxhash64("series_id"), F.lit(buckets)).cast("int"))
    if held is not None:
        touched = fresh.select(column).distinct()
        others = held.join(touched, column, "left_semi").join(
            fresh.select("series_id").distinct(), "series_id", "left_anti")
        fresh = fresh.unionByName(others, allowMissingColumns=True)
    _replace_partitions(fresh, path, column)


def read_series(spark: SparkSession, path: str) -> DataFrame:
    held = spark.read.parquet(path)
    return held.drop(BUCKET_COLUMN.format(stored_buckets(held)))


# --- append-only history -----------------------------------------------------------------------

def write_history(log: DataFrame, path: str) -> None:
    """First write of a history, partitioned by year of the observation day."""
    _balanced(log.withColumn("year", F.year("as_of")), "year").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Every stored line with all its vintages."""
    return spark.read.parquet(path)


def read_history_lines(spark: SparkSession, path: str) -> DataFrame:
    """Import of a history kept as JSON lines, one record per line."""
    return spark.read.schema(schemas.BAR).json(path)


def append_history(batch: DataFrame, path: str, tolerance: float = bitemporal.VALUE_TOLERANCE) -> DataFrame:
    """Append a batch to the stored history and return the per-series summary.

    Only years with an accepted change are rewritten, and only the batch's series in the years
    it reaches are compared: an older year matters for nothing but a provisional line left open
    there. A repeated call with the same batch finds every row stored and writes nothing.
    """
    spark = batch.sparkSession
    stored = _read_or_none(spark, path)
    if stored is None:
        stored = spark.createDataFrame([], batch.schema).withColumn("year", F.year("as_of"))
    first_year = batch.agg(F.min(F.year("as_of"))).first()[0]
    if first_year is None:
        return bitemporal.append_summary(bitemporal.append_plan(stored.drop("year"), batch, tolerance))
    mine = stored.join(batch.select("series_id").distinct(), "series_id", "left_semi")
    near = mine.filter(F.col("year") >= first_year)
    still_open = mine.filter((F.col("year") < first_year) & F.col("provisional"))
    plan = cut_lineage(bitemporal.append_plan(near.unionByName(still_open).drop("year"), batch, tolerance))
    changes = plan.filter("NOT refused AND action <> 'skip'")
    years = [row["year"] for row in changes.select(F.year("as_of").alias("year")).distinct().collect()]
    if years:
        touched = stored.filter(F.col("year").isin(years)).drop("year")
        _replace_partitions(bitemporal.apply_plan(touched, plan).withColumn("year", F.year("as_of")), path, "year")
    return bitemporal.append_summary(plan)


def append_vintages(records: DataFrame, path: str) -> DataFrame:
    """Append vintage records not stored yet; returns one row with both counts."""
    spark = records.sparkSession
    held = _read_or_none(spark, path)
    unseen = records if held is None else bitemporal.unseen_vintages(held, records)
    counts = records.agg(F.count(F.lit(1)).alias("offered"))
    with _staged(unseen, "vintages") as fresh:
        result = cut_lineage(fresh.agg(F.count(F.lit(1)).alias("appended")).select(
            "appended", (counts.scalar() - F.col("appended")).alias("skipped")))
        fresh.write.mode("append").parquet(path)
    return result


# --- ledger and catalog ----------------------------------------------------------------------------

def write_ledger(declared: DataFrame, face_path: str, journal_path: str, run_at: dt.datetime, batch_id: int = 0,
                 cells: DataFrame | None = None, cells_path: str | None = None) -> None:
    """The face shows the last run that declared something; the journal keeps every such run and batch.

    Journal rows of one batch of one run share a partition, so a repeated batch replaces its own
    rows and no others. ``cells`` are all changed cells of the batch, without the cap that the named
    lists of a declaration have; they are kept in the same way under ``cells_path``. A batch that
    declares nothing, such as a replay, leaves the face as it is.
    """
    stamp = run_at.strftime("%Y-%m-%dT%H-%M-%SZ")

    def keep(rows: DataFrame, path: str) -> None:
        (rows.withColumns({"run_at": F.lit(stamp), "batch_id": F.lit(batch_id)}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_at", "batch_id").parquet(path))

    if cells is not None:
        with _staged(cells, "cells") as held:
            keep(held, cells_path)
    with _staged(declared, "ledger") as held:
        if not held.isEmpty():
            held.write.mode("overwrite").parquet(face_path)
            keep(held, journal_path)


def write_catalog(merged: DataFrame, path: str) -> None:
    with _staged(merged.drop("status"), "catalog") as staged:
        staged.write.mode("overwrite").parquet(path)
