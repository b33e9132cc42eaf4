"""Retail queries over customers, parts (products), orders and line items: scans,
projections, filters, aggregates, joins, CASE tiers, set operations, data quality."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import tiers
from tallyspark.functions.dates import ts_literal, year_range
from tallyspark.functions.money import cents, from_cents, mean_of, money, money_sum, net_price
from tallyspark.operators import quality as Q
from tallyspark.operators.relational import left_outer_join
from tallyspark.sources import standins as S
from tallyspark.sources.tables import Tables

# Status codes of the order table and their business labels.
STATUS_LABELS = [("F", "Delivered"), ("O", "Open"), ("P", "Pending")]
DELIVERED = "F"
PENDING = "P"
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


# --- scans and projections --------------------------------------------------

def scan_parquet(spark, sf_dir):
    return Tables(spark, sf_dir).customer()


def project_cols(spark, sf_dir):
    return Tables(spark, sf_dir).customer("c_name", "c_mktsegment", "c_nationkey")


def distinct_values(spark, sf_dir):
    return Tables(spark, sf_dir).part("p_type").distinct().orderBy("p_type")


def head_n(spark, sf_dir):
    return Tables(spark, sf_dir).orders().orderBy("o_orderkey").limit(10)


def tail_n(spark, sf_dir):
    return Tables(spark, sf_dir).orders().orderBy(F.desc("o_orderkey")).limit(5)


def sort_multi(spark, sf_dir):
    """Multi-key sort with explicit null placement (asc nulls last on every key)."""
    return S.customer_dim(Tables(spark, sf_dir)).orderBy(
        F.col("region").asc_nulls_last(), F.col("country").asc_nulls_last(),
        F.col("customer_name").asc_nulls_last())


# --- filters ------------------------------------------------------------------

def filter_eq(spark, sf_dir):
    o = Tables(spark, sf_dir).orders()
    return o.filter(F.col("o_orderstatus") == DELIVERED).select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")


def filter_range(spark, sf_dir):
    p = Tables(spark, sf_dir).part("p_partkey", "p_name", "p_retailprice")
    return p.filter(F.col("p_retailprice") > 990.0)


def filter_and(spark, sf_dir):
    p = Tables(spark, sf_dir).part("p_partkey", "p_name", "p_type", "p_retailprice")
    return p.filter((F.col("p_type") == "STANDARD") & (F.col("p_retailprice") > 950.0))


def filter_or(spark, sf_dir):
    o = Tables(spark, sf_dir).orders("o_orderkey", "o_orderstatus", "o_orderpriority")
    return o.filter((F.col("o_orderpriority") == "1-URGENT") | (F.col("o_orderpriority") == "2-HIGH")
                    | (F.col("o_orderstatus") == PENDING))


def filter_between_date(spark, sf_dir):
    """BETWEEN (inclusive) on the date plus <>: both reach the Parquet scan."""
    o = Tables(spark, sf_dir).orders("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    return o.filter(F.col("o_orderdate").between(ts_literal("1996-01-01"), ts_literal("1996-03-31"))
                    & (F.col("o_orderstatus") != "O"))


def filter_date_halfopen(spark, sf_dir):
    """year(d) = 1997 rewritten as a half-open range so it pushes down to the scan."""
    o = Tables(spark, sf_dir).orders("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return o.filter(year_range("o_orderdate", 1997) & (F.col("o_orderpriority") == "1-URGENT"))


def date_parts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders("o_orderdate", "o_totalprice")
    return o.groupBy(F.year("o_orderdate").alias("order_year")).agg(
        F.count(F.lit(1)).alias("order_count"), money_sum("o_totalprice").alias("revenue"))


def round_abs(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem("l_orderkey", "l_linenumber", "l_partkey",
                                        "l_extendedprice", "l_discount")
    net = F.round(net_price("l_extendedprice", "l_discount"), 2)
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     net.cast("double").alias("net_amount"),
                     F.abs(net - money("l_extendedprice")).cast("double").alias("discount_amount"))


# --- aggregates -----------------------------------------------------------------

def global_agg(spark, sf_dir):
    o = Tables(spark, sf_dir).orders("o_orderstatus", "o_totalprice")
    return o.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(F.when(F.col("o_orderstatus") == DELIVERED, money("o_totalprice"))).cast("double")
         .alias("delivered_revenue"),
        mean_of(F.sum(money("o_totalprice")), F.count("o_totalprice")).alias("avg_order_value"),
        F.min("o_totalprice").alias("min_order_value"),
        F.max("o_totalprice").alias("max_order_value"))


def agg_by_status(spark, sf_dir):
    o = Tables(spark, sf_dir).orders("o_orderstatus", "o_totalprice")
    return (o.groupBy(F.col("o_orderstatus").alias("status"))
             .agg(F.count(F.lit(1)).alias("order_count"),
                  money_sum("o_totalprice").alias("total_revenue"))
             .orderBy(F.desc("total_revenue")))


def agg_by_segment(spark, sf_dir):
    c = Tables(spark, sf_dir).customer("c_mktsegment", "c_acctbal")
    return c.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("customer_count"),
        mean_of(F.sum(money("c_acctbal")), F.count("c_acctbal")).alias("avg_balance"),
        F.min("c_acctbal").alias("min_balance"), F.max("c_acctbal").alias("max_balance"))


def price_range_by_type(spark, sf_dir):
    p = Tables(spark, sf_dir).part("p_type", "p_retailprice")
    return p.groupBy(F.col("p_type").alias("category")).agg(
        F.max("p_retailprice").alias("max_price"), F.min("p_retailprice").alias("min_price"))


def _avg_price_by_type(t: Tables) -> DataFrame:
    p = t.part("p_type", "p_retailprice")
    return p.groupBy(F.col("p_type").alias("category")).agg(
        F.round(F.sum(money("p_retailprice")) / F.count("p_retailprice"), 2).cast("double")
         .alias("avg_price"))


def having_avg(spark, sf_dir):
    """HAVING on an aggregate alias: a filter above the aggregate."""
    return _avg_price_by_type(Tables(spark, sf_dir)).filter(F.col("avg_price") > 950.0)


def revenue_by_category(spark, sf_dir):
    """Revenue per product category.  Line items are pre-aggregated per part key before
    the part join, so the join input shrinks from line grain to part grain."""
    t = Tables(spark, sf_dir)
    li = t.lineitem("l_partkey", "l_extendedprice")
    per_part = li.groupBy("l_partkey").agg(F.sum(cents("l_extendedprice")).alias("s"),
                                           F.count(F.lit(1)).alias("n"))
    p = t.part("p_partkey", "p_type")
    j = per_part.join(p, per_part.l_partkey == p.p_partkey)
    return (j.groupBy(F.col("p_type").alias("category"))
             .agg(from_cents(F.sum("s")).cast("double").alias("total_revenue"),
                  mean_of(from_cents(F.sum("s")), F.sum("n")).alias("avg_order_value"),
                  F.sum("n").alias("order_count"))
             .orderBy(F.desc("total_revenue")))


def status_pivot(spark, sf_dir):
    o = Tables(spark, sf_dir).orders("o_orderstatus")
    return o.agg(F.count_if(F.col("o_orderstatus") == DELIVERED).alias("delivered"),
                 F.count_if(F.col("o_orderstatus") != DELIVERED).alias("not_delivered"))


def status_summary(spark, sf_dir):
    """Per status: count, revenue and share of all orders (one aggregate + one-row total)."""
    o = Tables(spark, sf_dir).orders("o_orderstatus", "o_totalprice")
    per = o.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("order_count"), money_sum("o_totalprice").alias("total_revenue"))
    tot = per.agg(F.sum("order_count").alias("all_orders"))
    return (per.crossJoin(F.broadcast(tot))
               .select("status", "order_count", "total_revenue",
                       (F.col("order_count").cast("double") * 100.0 / F.col("all_orders"))
                       .alias("share_pct"))
               .orderBy(F.desc("total_revenue")))


def price_tier(spark, sf_dir):
    o = Tables(spark, sf_dir).orders("o_orderkey", "o_totalprice")
    return o.select("o_orderkey", "o_totalprice", tiers.price_tier("o_totalprice").alias("price_tier"))


def table_row_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    parts = [getattr(t, name)().agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("tbl"), "row_count")
             for name in ("customer", "part", "orders", "lineitem")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def executive_kpis(spark, sf_dir):
    """Headline KPIs in one row: delivered share, top customer by spend, top category by
    revenue, pending order count and value.  Every input is a one-row aggregate."""
    from tallyspark.plans.sales import customer_totals
    t = Tables(spark, sf_dir)
    o = t.orders("o_orderstatus", "o_totalprice")
    head = o.agg((F.count_if(F.col("o_orderstatus") == DELIVERED).cast("double") * 100.0
                  / F.count(F.lit(1))).alias("delivered_pct"),
                 F.count_if(F.col("o_orderstatus") == PENDING).alias("pending_orders"),
                 F.coalesce(F.sum(F.when(F.col("o_orderstatus") == PENDING, money("o_totalprice"))),
                            F.lit(0)).cast("double").alias("pending_value"))
    top_c = customer_totals(spark, sf_dir).agg(F.min_by(
        F.col("customer_name"), F.struct((-F.col("total_sales")).alias("s"),
                                         F.col("customer_id").alias("k"))).alias("top_customer"))
    top_k = revenue_by_category(spark, sf_dir).agg(F.min_by(
        F.col("category"), F.struct((-F.col("total_revenue")).alias("s"),
                                    F.col("category").alias("k"))).alias("top_category"))
    return head.crossJoin(F.broadcast(top_c)).crossJoin(F.broadcast(top_k))


# --- joins ----------------------------------------------------------------------

def join_inner(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = t.customer("c_custkey", "c_name")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
             .select("o_orderkey", "o_orderdate", "c_name", "o_totalprice").orderBy("o_orderdate", "o_orderkey"))


def join_three_way(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                    "l_extendedprice", "l_discount")
    p = t.part("p_partkey", "p_name")
    o = t.orders("o_orderkey")
    return (li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
              .select("l_orderkey", "l_linenumber", "p_name", "l_quantity", "l_extendedprice",
                      "l_discount"))


def _customers_vs_orders(t: Tables):
    c = t.customer("c_custkey", "c_name")
    o = S.orders_of_some(t, "o_orderkey", "o_custkey", "o_totalprice")
    return c, o


def join_left(spark, sf_dir):
    """Every customer with its orders (NULLs when none); skew-tolerant outer join."""
    c, o = _customers_vs_orders(Tables(spark, sf_dir))
    return (left_outer_join(c, o, "c_custkey", "o_custkey")
            .select("c_custkey", "c_name", "o_orderkey", "o_totalprice")
            .orderBy("c_custkey", "o_orderkey"))


def join_right(spark, sf_dir):
    """orders RIGHT JOIN customers == customers LEFT JOIN orders."""
    c, o = _customers_vs_orders(Tables(spark, sf_dir))
    return left_outer_join(c, o, "c_custkey", "o_custkey").select("c_custkey", "c_name", "o_orderkey")


def join_full_audit(spark, sf_dir):
    """FULL OUTER join of orders and their line items in one pass: every order with its
    line count, orders without lines and lines without an order, tagged."""
    t = Tables(spark, sf_dir)
    per_order = S.audit_lines(t).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    o = t.orders("o_orderkey", "o_custkey")
    j = o.join(per_order, o.o_orderkey == per_order.l_orderkey, "full")
    return j.select(
        F.coalesce("o_orderkey", "l_orderkey").alias("order_key"), "o_custkey",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.when(F.col("l_orderkey").isNull(), "order_without_lines")
         .when(F.col("o_orderkey").isNull(), "lines_without_order")
         .otherwise("matched").alias("audit"))


# --- data quality ---------------------------------------------------------------

def orphan_items(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = S.audit_lines(t, "l_partkey")
    return Q.orphans(li, "l_orderkey", t.orders("o_orderkey"), "o_orderkey")


def orders_without_items(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders("o_orderkey", "o_custkey", "o_orderdate")
    return Q.orphans(o, "o_orderkey", S.audit_lines(t), "l_orderkey")


def dq_duplicate_key(spark, sf_dir):
    p = Tables(spark, sf_dir).part("p_name")
    return Q.duplicate_keys(p, "p_name")


def dq_range(spark, sf_dir):
    """CHECK (c_acctbal >= 0): rows where the predicate is FALSE (NULL passes)."""
    c = Tables(spark, sf_dir).customer("c_custkey", "c_name", "c_acctbal")
    return c.filter(Q.row_violation(Q.Rule("acctbal_non_negative", "check", "c_acctbal",
                                           "c_acctbal >= 0")))


def dq_domain(spark, sf_dir):
    o = S.audit_orders(Tables(spark, sf_dir)).select("o_orderkey", "o_orderstatus")
    return o.filter(Q.row_violation(Q.Rule("status_domain", "domain", "o_orderstatus",
                                           [s for s, _ in STATUS_LABELS])))


def dq_length(spark, sf_dir):
    p = Tables(spark, sf_dir).part("p_partkey", "p_name")
    return p.filter(Q.row_violation(Q.Rule("name_length", "max_length", "p_name", 10)))


def revenue_reconcile(spark, sf_dir):
    """Header total vs recomputed line total (net of discount, rounded half-up to cents);
    reports every order whose gap exceeds 0.01."""
    t = Tables(spark, sf_dir)
    li = t.lineitem("l_orderkey", "l_extendedprice", "l_discount")
    o = t.orders("o_orderkey", "o_totalprice")
    return Q.reconcile(o, li, "o_orderkey", "o_totalprice",
                       net_price("l_extendedprice", "l_discount"), line_key="l_orderkey")


# --- write-side operations expressed as DataFrame transformations -----------------

def apply_updates(spark, sf_dir):
    """UPDATE products SET stock = stock - sold WHERE ...: stock (100 x size) reduced by the
    quantity on pending orders, as a left join with a pre-aggregated adjustments table."""
    t = Tables(spark, sf_dir)
    li = t.lineitem("l_orderkey", "l_partkey", "l_quantity")
    o = t.orders("o_orderkey", "o_orderstatus").filter(F.col("o_orderstatus") == PENDING)
    sold = li.join(o, li.l_orderkey == o.o_orderkey, "left_semi") \
        .groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("sold"))
    p = t.part("p_partkey", "p_name", "p_size")
    j = p.join(sold, p.p_partkey == sold.l_partkey, "left")
    return j.select("p_partkey", "p_name",
                    (F.col("p_size").cast("bigint") * 100 - F.coalesce("sold", F.lit(0)))
                    .alias("stock_qty"))


NEW_ORDER_ROWS = [(-1, 1, "P", 1598.00, dt.datetime(1998, 8, 2), "1-URGENT"),
                  (-2, 2, "P", 999.00, dt.datetime(1998, 8, 2), "5-LOW")]


def _new_orders(spark) -> DataFrame:
    from tallyspark.sources.tables import SCHEMAS
    return spark.createDataFrame(NEW_ORDER_ROWS, SCHEMAS["orders"])


def append_rows(spark, sf_dir):
    """INSERT INTO orders VALUES (...): the table plus an appended batch (unionByName)."""
    return Tables(spark, sf_dir).orders().unionByName(_new_orders(spark))


def inline_values(spark, sf_dir):
    """A VALUES lookup (status code -> label, 3 rows, broadcast) joined to every order."""
    labels = spark.createDataFrame(STATUS_LABELS, "status string, status_label string")
    o = Tables(spark, sf_dir).orders("o_orderkey", "o_orderstatus")
    j = o.join(F.broadcast(labels), o.o_orderstatus == labels.status, "left")
    return j.groupBy("status_label").agg(F.count(F.lit(1)).alias("order_count"))


def cross_pivot(spark, sf_dir):
    """Department x region head count, wide: pivot with the value list given, so no
    extra job is spent discovering the pivot values."""
    st = S.staff(Tables(spark, sf_dir))
    wide = st.groupBy("department").pivot("region", REGIONS).count()
    return wide.fillna(0, subset=REGIONS)

