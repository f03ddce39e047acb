"""Feature tables: preparation, scaling, folds, holdouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import hash_bucket, hash_number


def feature_prep(
    df: DataFrame, key: str, drop: list[str], yes_no: list[str], label: str, true_value: str = "True."
) -> DataFrame:
    """Key, features as doubles and a 0/1 label; yes/no columns become 1/0."""
    features = [c for c in df.columns if c not in {key, label, *drop}]
    prepared = [
        ((F.col(c) == "yes") if c in yes_no else F.col(c)).cast("double").alias(c) for c in features
    ]
    return df.select(key, *prepared, (F.col(label) == true_value).cast("int").alias("label"))


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population standard deviation; a constant column becomes 0.

    All means and deviations come from one aggregate, read as a scalar.
    """
    stats = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns])
    ).scalar()

    def scaled(c: str):
        mean, spread = stats.getField(c).getField("m"), stats.getField(c).getField("s")
        return (F.col(c) - mean) / F.when(spread == 0, 1.0).otherwise(spread)

    return df.withColumns({c: scaled(c) for c in columns})


def kfold_assign(df: DataFrame, key: str, folds: int = 5, seed: int = 0) -> DataFrame:
    """A fold per row from a seeded hash of its key: the same on every run and partitioning."""
    return df.withColumn("fold", hash_bucket(seed, folds, key))


def holdout_split(df: DataFrame, key: str, share: float, seed: int = 0) -> DataFrame:
    """``is_test`` true for about ``share`` of the keys."""
    return df.withColumn("is_test", hash_number(seed, key) < int(share * 2**32))
