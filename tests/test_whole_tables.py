"""Queries that must read their tables whole."""

from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_entry_sums_every_order(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    customers = spark.read.parquet(f"{SF}/customer.parquet").where("c_acctbal > 0")
    of_kept = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi").count()
    assert entry.entry(spark).agg(F.sum("total_orders")).first()[0] == of_kept
