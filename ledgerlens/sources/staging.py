"""Typed staging tables over Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schema import TRANSACTION_SCHEMA, VENDOR_SCHEMA, require_columns


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` in its order and types; a value that does not fit is NULL."""
    require_columns(df, schema.fieldNames())
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            F.col(f.name) if types[f.name] == f.dataType else F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_staging_transactions(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.parquet(path), TRANSACTION_SCHEMA)


def read_staging_vendors(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.parquet(path), VENDOR_SCHEMA)


def register_views(transactions: DataFrame, vendors: DataFrame) -> None:
    """Name the staging tables for `spark.sql`."""
    transactions.createOrReplaceTempView("staging_transactions")
    vendors.createOrReplaceTempView("vendors")
