"""Gold aggregates (A1-A3, J1), kept up by changes (K6) or from mergeable sketches (A3).

Both aggregate before any join, so every mapper combines its rows per key
first and a customer or day holding a large share of orders costs one partial
row per mapper, not a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import MONEY

#: Registers of a distinct-count sketch are 2 to this power; its relative standard error is 1.04 over their root.
SKETCH_BITS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def customer_order_summary(
    customers: DataFrame,
    orders: DataFrame,
    key: str = "customer_id",
    order_id: str = "order_id",
    amount: str = "order_amount",
    order_date: str = "order_date",
    attributes=(),
) -> DataFrame:
    """Per customer: order count, exact total, average and last order date.

    Customers without orders are kept with 0 orders and NULL amounts. The
    customer side is one row per key (the silver current view), so aggregating
    orders first and then joining equals join-then-group.
    """
    per_customer = orders.groupBy(key).agg(
        F.count(order_id).alias("total_orders"),
        F.sum(F.col(amount).cast(MONEY)).alias("_sum"),
        F.count(amount).alias("_n"),
        F.max(order_date).alias("last_order_date"),
    )
    joined = customers.select(key, *attributes).join(per_customer, key, "left")
    return joined.select(
        key,
        *attributes,
        F.coalesce(F.col("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.col("_sum").cast("double").alias("total_order_amount"),
        F.try_divide(F.col("_sum").cast("double"), F.col("_n")).alias("avg_order_amount"),
        F.col("last_order_date"),
    )


def daily_order_metrics(
    orders: DataFrame,
    customer: str = "customer_id",
    amount: str = "order_amount",
    order_date: str = "order_date",
) -> DataFrame:
    """A2 / A3: per day: orders, exact revenue, distinct customers, average order value."""
    day = F.date_trunc("day", F.col(order_date)).cast("timestamp_ntz").alias("order_day")
    return (
        orders.groupBy(day)
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum(F.col(amount).cast(MONEY)).alias("_sum"),
            F.count_distinct(customer).alias("unique_customers"),
            F.count(amount).alias("_n"),
        )
        .select(
            "order_day",
            "total_orders",
            F.col("_sum").cast("double").alias("total_revenue"),
            "unique_customers",
            F.try_divide(F.col("_sum").cast("double"), F.col("_n")).alias("avg_order_value"),
        )
    )


def distinct_sketches(rows: DataFrame, column: str, time_col: str, unit: str = "day") -> DataFrame:
    """A3: one sketch of the distinct values per period, as binary to be stored; a few kilobytes each, built
    with partial sketches in every task. Null values do not count, as in ``count(DISTINCT)``."""
    period = F.date_trunc(unit, F.col(time_col)).cast("timestamp_ntz").alias("period")
    return rows.groupBy(period).agg(F.hll_sketch_agg(F.col(column), SKETCH_BITS).alias("sketch"))


def distinct_over(sketches: DataFrame, unit: str) -> DataFrame:
    """A3: distinct values per longer period from stored sketches, without reading a row again. The estimate is
    within three times ``SKETCH_ERROR`` of the exact number in 997 of 1,000 cases."""
    period = F.date_trunc(unit, F.col("period")).cast("timestamp_ntz").alias("period")
    return sketches.groupBy(period).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


class MaintainedSummary:
    """K6 / A1 / A2: count, exact total and latest time per group, kept up by the images of changed rows
    (``_op`` 1 or -1, see ``store.KeyedTable``) instead of being rebuilt.

    A batch reads its images and the state buckets of their groups, and writes these buckets. Counts and totals
    are added; the latest time only needs the source where a group loses a row as late as its latest: the rows
    of those groups, and of them two columns, are read again. A group without rows stays with count 0 and is not
    shown. A group remembers the batch it last took, so a retried batch is applied once; batches of a table come
    one after the other.
    """

    def __init__(self, spark, root: str, group: str, amount: str, at: str, buckets: int = 16):
        self.spark, self.root, self.group, self.amount, self.at, self.buckets = spark, root.rstrip("/"), group, amount, at, buckets

    def _state(self) -> DataFrame | None:
        from ..store import BUCKET, read_table

        return read_table(self.spark, self.root, [(BUCKET, "int")])

    def apply(self, images: DataFrame, source: DataFrame, batch_id: str) -> None:
        """``source``: all rows after the batch, from which latest times are taken again."""
        from ..store import BUCKET, Layout, _put, bucket_of

        g, op = F.col(self.group), F.col("_op")
        money, at = F.col(self.amount).cast(MONEY), F.col(self.at)
        delta = images.groupBy(g.alias("_g")).agg(
            F.sum(op).alias("d_rows"),
            F.coalesce(F.sum(F.when(money.isNotNull(), op)), F.lit(0)).alias("d_n"),
            F.coalesce(F.sum(F.when(op == 1, money).otherwise(-money)), F.lit(0).cast(MONEY)).alias("d_sum"),
            F.max(F.when(op == 1, at)).alias("came"),
            F.max(F.when(op == -1, at)).alias("went"),
        )
        old, kind = self._state(), images.schema
        if old is None:
            old = images.limit(0).select(
                g, F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("decimal(38,6)").alias("total"),
                at.alias("latest"), F.lit("").alias("last_batch"), F.lit(0).alias(BUCKET),
            )
        else:
            # at most ``buckets`` numbers reach the driver
            touched = [r[0] for r in images.select(bucket_of([self.group], self.buckets)).distinct().collect()]
            old = old.where(F.col(BUCKET).isin(touched))
        both = old.join(delta, g.eqNullSafe(F.col("_g")), "full_outer")
        new = F.col("d_rows").isNotNull() & ~F.coalesce(F.col("last_batch") == batch_id, F.lit(False))
        lost = new & (F.col("went") >= F.col("latest")) & ~F.coalesce(F.col("came") >= F.col("went"), F.lit(False))
        key = F.when(F.col("rows").isNotNull(), g).otherwise(F.col("_g"))
        zero = F.lit(0).cast("decimal(38,6)")
        merged = both.select(
            key.alias(self.group),
            (F.coalesce("rows", F.lit(0)) + F.when(new, F.col("d_rows")).otherwise(F.lit(0))).cast("long").alias("rows"),
            (F.coalesce("n", F.lit(0)) + F.when(new, F.col("d_n")).otherwise(F.lit(0))).cast("long").alias("n"),
            (F.coalesce("total", zero) + F.when(new, F.col("d_sum").cast("decimal(38,6)")).otherwise(zero)).cast("decimal(38,6)").alias("total"),
            F.when(new, F.greatest("latest", "came")).otherwise(F.col("latest")).alias("latest"),
            F.when(new, F.lit(batch_id)).otherwise(F.col("last_batch")).alias("last_batch"),
            F.coalesce(lost, F.lit(False)).alias("_lost"),
        )
        again = merged.where("_lost").select(g.alias("_g"))
        times = source.join(again, g.eqNullSafe(F.col("_g")), "left_semi").groupBy(g.alias("_g")).agg(F.max(at).alias("_at"), F.lit(True).alias("_has"))
        out = merged.join(times, g.eqNullSafe(F.col("_g")), "left").select(
            self.group, "rows", "n", "total", F.when(F.col("_lost"), F.col("_at")).otherwise(F.col("latest")).alias("latest"), "last_batch"
        )
        Layout(self.spark, self.root).grown(out.schema, batch_id, self.buckets)
        _put(out.withColumn(BUCKET, bucket_of([self.group], self.buckets)).hint("rebalance", BUCKET), self.root, BUCKET)

    def read(self) -> DataFrame:
        """Per group: total_orders, total_order_amount, avg_order_amount and last_order_date, as a full rebuild gives them."""
        total = F.when(F.col("n") > 0, F.col("total").cast("double"))
        return self._state().where("rows > 0").select(
            self.group,
            F.col("rows").alias("total_orders"),
            total.alias("total_order_amount"),
            F.try_divide(total, F.col("n")).alias("avg_order_amount"),
            F.col("latest").alias("last_order_date"),
        )
