"""Reproducible random subsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def eval_sample(names: DataFrame, count: int = 20, seed: int = 42) -> DataFrame:
    """min(count, n) distinct names without replacement, the same ones for the same seed."""
    ticket = F.md5(F.concat(F.col("name"), F.lit(f"#{seed}")))
    return names.withColumn("ticket", ticket).orderBy("ticket", "name").limit(count).drop("ticket")
