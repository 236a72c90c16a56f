"""Curated tables in the session catalog, so SQL names them and prunes their partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def register_table(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_cols: Sequence[str]) -> None:
    """An external Parquet table ``name`` over ``path``, with the partitions that exist. The declared
    schema spares a look into the files; a table of that name is kept, and its partitions renewed."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{c}`" for c in partition_cols)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet PARTITIONED BY ({by}) LOCATION '{path}'")
    refresh_partitions(spark, name)


def refresh_partitions(spark: SparkSession, name: str) -> None:
    """Enter partitions that were written or dropped since."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def add_partition(spark: SparkSession, name: str, **values: str) -> None:
    """Enter one partition, as a daily run does for its day, without listing the others."""
    spec = ", ".join(f"`{k}` = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")
