"""Where results go: the splits as one partitioned parquet table, metadata as JSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLITS = ["train", "validation", "test"]


def write_splits(df: DataFrame, path: str) -> None:
    """One job for all three sets; readers of one set prune the other folders."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def split_counts_by_country(df: DataFrame) -> DataFrame:
    """Rows per split and country; rows without a country are not counted."""
    return (
        df.where(F.col("country_code").isNotNull())
        .groupBy("split", "country_code")
        .agg(F.count("*").alias("n_rows"))
    )


def run_metadata(splits: DataFrame, config: dict, elapsed: str) -> DataFrame:
    """One row: the configuration, the elapsed time and the size of each set per country."""
    sizes = split_counts_by_country(splits)
    per_split = [
        F.map_from_entries(
            F.array_sort(
                F.collect_list(F.when(F.col("split") == s, F.struct("country_code", "n_rows")))
            )
        ).alias(f"{s}_data_size_per_country")
        for s in SPLITS
    ]
    return sizes.agg(*per_split).select(
        F.lit(json.dumps(config, sort_keys=True, default=str)).alias("config"),
        F.lit(elapsed).alias("preprocessing_time"),
        "*",
    )


def write_metadata(metadata: DataFrame, path: str) -> None:
    metadata.coalesce(1).write.mode("overwrite").json(path)
