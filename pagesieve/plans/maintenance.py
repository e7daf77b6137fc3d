"""Upkeep of the result table: back up, purge, reset the mark."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.sources.marks import reset_mark
from pagesieve.sources.results import Sink


def save_table(df: DataFrame, table: str, folder: str | None = None, mode: str = "errorifexists") -> None:
    """Store as a catalog table, below ``folder`` where given, else in the warehouse."""
    writer = df.write.mode(mode).format("parquet")
    if "batch_id" in df.columns:  # a job's result keeps its batches apart
        writer = writer.partitionBy("batch_id")
    if folder:
        writer = writer.option("path", f"{folder.rstrip('/')}/{table}-{uuid.uuid4().hex}")
    writer.saveAsTable(table)


def table_sink(table: str, folder: str | None = None) -> Sink:
    """A sink for the incremental jobs: every batch a partition of a catalog table, made by the
    first one. A repeated batch replaces its own. Upkeep works on the same name, so the next
    batch goes to the table as it is then; a batch repeated after its rows were purged is new."""

    def write(rows: DataFrame, batch: str) -> None:
        spark = rows.sparkSession
        if not spark.catalog.tableExists(table):
            schema = T.StructType([*rows.schema, T.StructField("batch_id", T.StringType())])
            save_table(spark.createDataFrame([], schema), table, folder)
        columns = ", ".join(f"`{name}`" for name in spark.table(table).columns if name != "batch_id")
        insert = f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = '{batch}') SELECT {columns} FROM {{rows}}"
        spark.sql(insert, rows=rows)

    return write


def backup_table(spark: SparkSession, table: str, day: date, folder: str | None = None) -> str:
    """Copy the table to ``<table>_yyyy_MM_dd_bak``; fails if that day's copy exists."""
    copy = f"{table}_{day:%Y_%m_%d}_bak"
    save_table(spark.table(table), copy, folder)
    return copy


def _location(spark: SparkSession, table: str):
    described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'")
    return spark._jvm.org.apache.hadoop.fs.Path(described.first()["data_type"])


def _drop_with_files(spark: SparkSession, table: str, folder: str | None) -> None:
    """Drop a table, and its files too where ``save_table`` put them below ``folder``."""
    place = _location(spark, table)
    spark.sql(f"DROP TABLE {table}")
    if folder:  # a table outside the warehouse, whose files Spark leaves
        files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        parent = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/"))
        if files.makeQualified(parent).equals(files.makeQualified(place.getParent())):
            files.delete(place, True)


def purge_table(spark: SparkSession, table: str, mark: int, folder: str | None = None) -> None:
    """Drop rows with ``offset < mark``.

    The rows that stay are written as a new table, which takes the old one's name only once it is
    complete. Files are never changed in place; the old ones go once the new table has its name.
    A purge that breaks off between the two renames leaves ``<table>_old`` and ``<table>_kept``,
    both whole, and the next one says so.
    """
    kept, old = f"{table}_kept", f"{table}_old"
    for leftover in (kept, old):
        if spark.catalog.tableExists(leftover):
            raise ValueError(f"{leftover} is left from a purge that broke off; look at it first")
    save_table(spark.table(table).where(F.col("offset") >= mark), kept, folder)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {kept} RENAME TO {table}")
    _drop_with_files(spark, old, folder)


def maintain(
    spark: SparkSession, table: str, marks: str, mark: int, day: date, folder: str | None = None
) -> str:
    """Back up, purge what is below ``mark``, set the saved offset back to 0, in this order."""
    copy = backup_table(spark, table, day, folder)
    purge_table(spark, table, mark, folder)
    reset_mark(spark, marks)
    return copy
