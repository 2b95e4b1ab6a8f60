"""Card transactions derived from the order tables.

The joins are plain equi-joins without hints: Spark broadcasts nation and customer only when
their measured size allows it, and AQE splits a customer that holds too many orders.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


#: Declared schemas: nothing is read from the files before a query runs.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order, with a train/test ``split`` column."""
    orders = read_table(spark, folder, "orders")
    customer = read_table(spark, folder, "customer")
    nation = read_table(spark, folder, "nation")
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.selectExpr(
        "o_orderkey AS id",
        "timestampadd(SECOND, CAST((o_orderkey * 7919) % 86400 AS INT), o_orderdate) "
        "AS trans_date_trans_time",
        "o_custkey AS cc_num",
        "concat('merchant_', CAST(o_orderkey % 700 AS STRING)) AS merchant",
        "o_orderpriority AS category",
        "o_totalprice / 1000.0e0 AS amt",
        "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
        "n_name AS state",
        "25.0e0 + ((c_custkey * 31) % 2400) / 100.0e0 AS lat",
        "-125.0e0 + ((c_custkey * 37) % 5800) / 100.0e0 AS long",
        "500 + (c_custkey * 104729) % 1500000 AS city_pop",
        "date_add(DATE'1925-01-01', CAST((c_custkey * 7907) % 30000 AS INT)) AS dob",
        "25.0e0 + ((c_custkey * 31) % 2400) / 100.0e0 + ((o_orderkey * 13) % 240 - 120) / 100.0e0 "
        "AS merch_lat",
        "-125.0e0 + ((c_custkey * 37) % 5800) / 100.0e0 "
        "+ ((o_orderkey * 29) % 240 - 120) / 100.0e0 AS merch_long",
        "CASE WHEN o_totalprice > 400000 AND (o_orderkey * 17 + c_custkey * 3) % 10 < 3 "
        "THEN 1 ELSE 0 END AS is_fraud",
        "CASE WHEN o_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS split",
    )


def split_of(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name).drop("split")
