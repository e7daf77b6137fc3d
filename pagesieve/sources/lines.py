"""Text files in which a line's place means something: word lists, vocabularies, vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = ["file", "block"]


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, value``: lines from 0 in file order, over all files of ``path`` by name.

    Files are read in blocks, in parallel. Rows are numbered inside their block, whose size Spark
    bounds, and only one count per block is summed up to give each block its first number.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    before = Window.orderBy(*BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        lines.groupBy(*BLOCK)
        .agg(F.count("*").alias("n_lines"))
        .select(*BLOCK, F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("first"))
    )
    inside = F.row_number().over(Window.partitionBy(*BLOCK).orderBy("place")) - 1
    return (
        lines.withColumn("inside", inside)
        .join(firsts, BLOCK)
        .select((F.col("first") + F.col("inside")).alias("line"), "value")
    )


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """``word``: one per line, stripped, each once."""
    word = F.regexp_replace("value", r"\A[\s\p{Z}]+|[\s\p{Z}]+\z", "")
    return spark.read.text(path).select(word.alias("word")).distinct()


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``word, id``: a word's id is the number of its line."""
    return numbered_lines(spark, path).select(
        F.col("value").alias("word"), F.col("line").cast("long").alias("id")
    )


def write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    """One word per line in id order; ids must run from 0 without gaps."""
    vocabulary.orderBy("id").select("word").write.text(path)


def write_vocabulary_size(vocabulary: DataFrame, path: str) -> None:
    vocabulary.agg(F.count("*").cast("string").alias("value")).write.text(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``word, id, vector`` of a word-vector text file.

    Its first line holds the number of words and of dimensions; every other line a word and its
    numbers. Ids count the words from 0.
    """
    parts = F.split(F.rtrim("value"), " ")
    return (
        numbered_lines(spark, path)
        .where(F.col("line") > 0)
        .select((F.col("line") - 1).cast("long").alias("id"), parts.alias("parts"))
        .select(
            F.col("parts")[0].alias("word"),
            "id",
            F.slice("parts", F.lit(2), F.size("parts") - 1).cast("array<float>").alias("vector"),
        )
    )


def write_vectors(vectors: DataFrame, path: str) -> None:
    """The opposite of ``read_vectors``."""
    header = vectors.agg(
        F.concat_ws(" ", F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).alias("value")
    ).select(F.lit(-1).cast("long").alias("id"), "value")
    body = vectors.select(
        "id", F.concat_ws(" ", "word", F.col("vector").cast("array<string>")).alias("value")
    )
    header.unionByName(body).orderBy("id").select("value").write.text(path)


def vocabulary_of(vectors: DataFrame) -> DataFrame:
    return vectors.select("word", "id")

