"""Hyper-parameters of the training job from a flat JSON file."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pagesieve.functions.text import parse_ints


@dataclass
class TrainingParams:
    filter_sizes: list[int] = field(default_factory=lambda: [1, 2, 3])
    l2_reg_lambda: float = 0.2
    num_epochs: int = 200
    num_features: int = 1 << 18


def read_params(spark: SparkSession, path: str) -> TrainingParams:
    """Known keys of the file; ``filter_sizes`` is a text such as ``1,2,3``."""
    table = spark.read.json(path, multiLine=True)
    if "filter_sizes" in table.columns:
        table = table.withColumn("filter_sizes", parse_ints(F.col("filter_sizes")))
    known = [name for name in TrainingParams.__dataclass_fields__ if name in table.columns]
    row = table.select(*known).first()
    return TrainingParams(**row.asDict()) if row else TrainingParams()
