"""Customer totals kept by version: a published batch adds a small table of its own totals.

A state row holds what a customer's lines of one batch add up to; states of a customer merge by
sum, min and max, so a report over everything reads the states and never the lines.  An order
counts in the batch that brings its first line: whether an order has lines already is asked of the
key filters of the published lines.  The state is published in the same commit as its lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.money import cents, from_cents, profit_units
from tallyspark.sources import versions as V

LINES, STATE = "lines", "customer_state"
FOLD_STATES = 16             # state versions after which they are merged into one
LINE_SCHEMA = ("order_id bigint, customer_id bigint, order_date date, product_id bigint, sales double, "
               "quantity double, discount double, unit_cost double")


def batch_state(lines: DataFrame, known_orders: DataFrame) -> DataFrame:
    """(customer_id, sales_cents, profit_units, n_orders, n_lines, max_line, first_day, last_day) of a batch
    of lines; orders among ``known_orders`` (order_id) don't count again."""
    per_order = lines.groupBy("order_id", "customer_id", "order_date").agg(
        F.sum(cents("sales")).alias("sales_cents"),
        F.sum(profit_units("sales", "discount", "quantity", "unit_cost")).alias("profit_units"),
        F.count(F.lit(1)).alias("n_lines"), F.max("sales").alias("max_line"))
    known = known_orders.select(F.col("order_id").alias("_known")).distinct()
    per_order = per_order.join(known, per_order["order_id"] == known["_known"], "left")
    return per_order.groupBy("customer_id").agg(
        F.sum("sales_cents").alias("sales_cents"), F.sum("profit_units").alias("profit_units"),
        F.sum(F.col("_known").isNull().cast("long")).alias("n_orders"), F.sum("n_lines").alias("n_lines"),
        F.max("max_line").alias("max_line"), F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))


def merged(states: DataFrame) -> DataFrame:
    """One state a customer."""
    return states.groupBy("customer_id").agg(
        *[F.sum(c).alias(c) for c in ("sales_cents", "profit_units", "n_orders", "n_lines")],
        F.max("max_line").alias("max_line"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


def add_batch(spark: SparkSession, root: str, lines: DataFrame) -> dict:
    """Publish a batch of lines together with its customer states."""
    known = V.stored_keys(spark, root, LINES, lines.select("order_id"), "order_id")
    return V.publish(spark, root, {LINES: lines, STATE: batch_state(lines, known)}, keys={LINES: "order_id"})


def fold_states(spark: SparkSession, root: str, after: int = FOLD_STATES) -> bool:
    """Merge the state versions into one once there are more than ``after``."""
    content = V.manifest(spark, root)[1].get(STATE)
    if content is None or len(content.paths) <= after:
        return False
    V.publish(spark, root, {}, replaces={STATE: merged(V.read_content(spark, content))})
    return True


def customer_totals(spark: SparkSession, root: str) -> DataFrame:
    """The customers' totals over all published batches, from the states alone; the columns of
    ``standins.customer_sales``."""
    s = merged(V.resolve(spark, root, STATE))
    return s.select("customer_id", from_cents(F.col("sales_cents")).alias("total_sales_dec"),
                    F.col("n_orders").alias("total_orders"), "n_lines", F.col("max_line").alias("max_single_order"),
                    F.col("first_day").alias("first_order"), F.col("last_day").alias("last_order"),
                    from_cents(F.col("profit_units"), 4).alias("total_profit_dec"))
