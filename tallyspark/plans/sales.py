"""Customer sales reports over the line-grain sales fact (ranking, tiers, dashboards)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions import tiers
from tallyspark.functions.money import cents, mean_of
from tallyspark.operators.materialize import materialize, materialize_observed
from tallyspark.operators.ranking import global_order, ordered, partitioned_row_number, with_ranks
from tallyspark.sources import standins as S
from tallyspark.sources.tables import Tables


# Customers by total sales (twins tie), then by key.
BY_SALES = [("total_sales_dec", True), ("customer_id", False)]


def customer_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-customer totals, profit, order count, averages and extremes, global RANK and
    NTILE(4) by total sales, an above/below-average tier and a buyer type."""
    t = Tables(spark, sf_dir)
    return dashboard(S.twin_sales(t, with_profit=True), S.twin_dim(t))


def dashboard(sales: DataFrame, dim: DataFrame) -> DataFrame:
    """The dashboard of customers' totals (``customer_sales`` columns) and their dimension."""
    # the totals are written once, in sales order; their sum and count are observed on the way
    totals = ordered(sales, BY_SALES, F.sum("total_sales_dec").alias("sum_all"))
    ranked = with_ranks(totals, rank_prefixes=(1,), ntiles=(4,), dense=False)
    sum_all = F.lit(totals.metrics["sum_all"])
    ranked = ranked.withColumn("above", F.col("total_sales_dec") * F.lit(totals.n) > sum_all)
    out = ranked.join(dim, "customer_id").select(
        "customer_id", "customer_name", "segment", "region",
        F.col("total_sales_dec").cast("double").alias("total_sales"),
        F.col("total_profit_dec").cast("double").alias("total_profit"),
        "total_orders",
        mean_of(F.col("total_sales_dec"), F.col("n_lines")).alias("avg_order_value"),
        "max_single_order", "first_order", "last_order",
        F.col("_g_rank1").alias("sales_rank"),
        F.col("_g_ntile4").alias("quartile"),
        tiers.sales_tier(F.col("above")).alias("sales_tier"),
        tiers.buyer_type("total_orders").alias("buyer_type"),
    )
    return out.orderBy("sales_rank", "customer_id")


# ---------------------------------------------------------------------------
# building blocks
# ---------------------------------------------------------------------------

def _totals_with_names(t: Tables, with_profit: bool = False) -> DataFrame:
    return S.customer_sales(t, with_profit).join(S.customer_dim(t), "customer_id")


def top_k_ranked(df: DataFrame, value: str, k: int, descending: bool = True,
                 dense: bool = False, rank_name: str = "rnk",
                 materialize_input: bool = True) -> DataFrame:
    """Rows whose RANK (or DENSE_RANK) by ``value`` is <= k, ties kept, with the rank.

    The k best values come from a distributed top-k (per-partition partial top-k, then a
    merge of at most k rows per partition); they are the only rows that can outrank a
    kept row, so rank = 1 + (number of those k values strictly better).  No window over
    the whole set, and a value repeated in millions of rows costs nothing extra."""
    if materialize_input:  # read twice below (top-k values, then the filter)
        df = materialize(df)
    order = F.col(value).desc() if descending else F.col(value).asc()
    src = df.select(value).filter(F.col(value).isNotNull())
    if dense:
        src = src.distinct()
    best = [r[0] for r in src.orderBy(order).limit(k).collect()]
    if not best:
        return df.withColumn(rank_name, F.lit(None).cast("bigint")).limit(0)
    edge = best[-1]
    x = F.col(value)
    keep = (x >= F.lit(edge)) if descending else (x <= F.lit(edge))
    better = F.lit(0)
    for b in best:
        better = better + F.when((F.lit(b) > x) if descending else (F.lit(b) < x), 1).otherwise(0)
    return df.filter(keep).withColumn(rank_name, (better + 1).cast("bigint"))


# ---------------------------------------------------------------------------
# reports over the line-grain sales fact
# ---------------------------------------------------------------------------

def customer_totals(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _totals_with_names(t).select(
        "customer_id", "customer_name",
        F.col("total_sales_dec").cast("double").alias("total_sales"),
        "total_orders").orderBy(F.desc("total_sales"), "customer_id")


def above_avg_orders(spark, sf_dir):
    """Lines whose sales exceed the average line sales.  The joined lines are written once; the
    sum and count behind the average are observed during that write."""
    t = Tables(spark, sf_dir)
    lines, seen = materialize_observed(
        S.sales_lines(t).select("order_id", "line_no", "customer_id", "product_id", "sales"),
        F.sum(cents("sales")).alias("s"))
    # for integer cents c: c * n > s  <=>  c > floor(s / n)
    cut = (seen["s"] or 0) // max(seen["n"], 1)
    hit = lines.filter(cents("sales") > F.lit(cut))
    return (hit.join(S.customer_dim(t).select("customer_id", "customer_name"), "customer_id")
               .join(S.product_dim(t).select("product_id", "product_name"), "product_id")
               .select("order_id", "line_no", "customer_name", "product_name", "sales")
               .orderBy(F.desc("sales"), "order_id", "line_no"))


def max_order_per_customer_ties(spark, sf_dir):
    """Lines whose sales are the highest of their customer, ties kept.  The correlated MAX becomes a
    pre-aggregated per-customer maximum joined back on it."""
    t = Tables(spark, sf_dir)
    per_cust = S.order_sales(t).groupBy(F.col("o_custkey").alias("customer_id")) \
        .agg(F.max("max_line_sales").alias("sales"))
    hit = S.repeated_lines(t).join(per_cust, ["customer_id", "sales"], "left_semi")
    return (hit.join(S.customer_dim(t).select("customer_id", "customer_name"), "customer_id")
               .select("order_id", "line_no", "customer_name", F.col("sales").alias("highest_sale"))
               .orderBy(F.desc("highest_sale"), "order_id", "line_no"))


def _with_avg(m: DataFrame) -> DataFrame:
    avg = m.agg(F.sum("total_sales_dec").alias("sum_all"), F.count(F.lit(1)).alias("n_cust"))
    return m.crossJoin(F.broadcast(avg))


def above_avg_customers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    m = _with_avg(S.customer_sales(t))
    hit = m.filter(F.col("total_sales_dec") * F.col("n_cust") > F.col("sum_all"))
    return (hit.join(S.customer_dim(t), "customer_id")
               .select("customer_id", "customer_name",
                       F.col("total_sales_dec").cast("double").alias("total_sales"))
               .orderBy(F.desc("total_sales"), "customer_id"))


def _ranked_customers(t: Tables, with_profit: bool = False, ntiles=(), rank: bool = True,
                      dense: bool = False) -> DataFrame:
    """Customers in the order (total sales DESC, id); RANK / DENSE_RANK over the total only
    when asked for."""
    m = S.twin_sales(t, with_profit)
    return global_order(m, BY_SALES,
                        rank_prefixes=(1,) if (rank or dense) else (), ntiles=ntiles,
                        dense=dense)


def rank_customers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = _ranked_customers(t)
    return (r.join(S.twin_dim(t), "customer_id")
             .select("customer_id", "customer_name",
                     F.col("total_sales_dec").cast("double").alias("total_sales"),
                     F.col("_g_rank1").alias("sales_rank"))
             .orderBy("sales_rank", "customer_id"))


def dense_rank_customers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = _ranked_customers(t, rank=False, dense=True)
    return (r.join(S.twin_dim(t), "customer_id")
             .select("customer_id", "customer_name",
                     F.col("total_sales_dec").cast("double").alias("total_sales"),
                     F.col("_g_dense1").alias("dense_rank"))
             .orderBy("dense_rank", "customer_id"))


def customer_quartile(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = _ranked_customers(t, ntiles=(4,), rank=False)
    return r.select("customer_id", F.col("total_sales_dec").cast("double").alias("total_sales"),
                    F.col("_g_ntile4").alias("quartile")).orderBy("quartile", "customer_id")


def customer_scorecard(spark, sf_dir):
    """Totals + RANK + DENSE_RANK on one ordering (one bucketed sort) + segment/region."""
    t = Tables(spark, sf_dir)
    r = _ranked_customers(t, with_profit=True, dense=True)
    return (r.join(S.twin_dim(t), "customer_id")
             .select("customer_id", "customer_name", "segment", "region",
                     F.col("total_sales_dec").cast("double").alias("total_sales"),
                     "total_orders",
                     F.col("total_profit_dec").cast("double").alias("total_profit"),
                     F.col("_g_rank1").alias("sales_rank"),
                     F.col("_g_dense1").alias("dense_rank"))
             .orderBy("sales_rank", "customer_id"))


def order_sequence(spark, sf_dir):
    """ROW_NUMBER per customer by (order date, order id), line key as final tie-break;
    balanced even when one customer owns a large share of all lines."""
    t = Tables(spark, sf_dir)
    lines = S.sales_lines(t)
    seq = partitioned_row_number(lines, ["customer_id"],
                                 ["order_date", "order_id", "line_no", "product_id", "supplier_id",
                                  "sales", "quantity", "discount"])
    return (seq.join(S.customer_dim(t).select("customer_id", "customer_name"), "customer_id")
               .select("customer_id", "customer_name", "order_id", "line_no", "order_date", "sales",
                       F.col("_p_rn").alias("order_seq"))
               .orderBy("customer_name", "order_seq"))


def dense_top3(spark, sf_dir):
    t = Tables(spark, sf_dir)
    m = S.twin_sales(t).withColumn("total_sales", F.col("total_sales_dec").cast("double"))
    top = top_k_ranked(m, "total_sales_dec", 3, dense=True, rank_name="sales_rank")
    return (top.join(S.twin_dim(t), "customer_id")
               .select("customer_id", "customer_name", "total_sales", "sales_rank")
               .orderBy("sales_rank", "customer_id"))


def rank_top5(spark, sf_dir):
    t = Tables(spark, sf_dir)
    m = S.twin_sales(t, with_profit=True)
    top = top_k_ranked(m, "total_sales_dec", 5, rank_name="rnk")
    return (top.join(S.twin_dim(t), "customer_id")
               .select("customer_id", "customer_name", "segment",
                       F.col("total_sales_dec").cast("double").alias("total_sales"),
                       F.col("total_profit_dec").cast("double").alias("total_profit"),
                       F.col("total_orders").alias("order_count"), "rnk")
               .orderBy("rnk", "customer_id"))


def rank_bottom5(spark, sf_dir):
    t = Tables(spark, sf_dir)
    m = S.twin_sales(t)
    low = top_k_ranked(m, "total_sales_dec", 5, descending=False, rank_name="rnk")
    return (low.join(S.twin_dim(t), "customer_id")
               .select("customer_id", "customer_name", "segment",
                       F.col("total_sales_dec").cast("double").alias("total_sales"),
                       F.col("total_orders").alias("order_count"), "rnk")
               .orderBy("rnk", "customer_id"))


def single_order_customers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    m = S.customer_sales(t).filter(F.col("total_orders") == 1)
    return (m.join(S.customer_dim(t), "customer_id")
             .select("customer_id", "customer_name", "segment", "region",
                     F.col("total_orders").alias("order_count"),
                     F.col("total_sales_dec").cast("double").alias("total_sales"))
             .orderBy(F.desc("total_sales"), "customer_id"))


def above_avg_margin(spark, sf_dir):
    """Customers above the average customer total, with the margin rounded half-up."""
    t = Tables(spark, sf_dir)
    m = _with_avg(S.customer_sales(t))
    hit = m.filter(F.col("total_sales_dec") * F.col("n_cust") > F.col("sum_all"))
    margin = (F.col("total_sales_dec") * F.col("n_cust") - F.col("sum_all")) / F.col("n_cust")
    return (hit.join(S.customer_dim(t), "customer_id")
               .select("customer_id", "customer_name", "segment", "region",
                       F.col("total_sales_dec").cast("double").alias("total_sales"),
                       (F.col("sum_all").cast("double") / F.col("n_cust")).alias("avg_total_sales"),
                       F.round(margin, 2).cast("double").alias("above_avg_by"))
               .orderBy(F.desc("total_sales"), "customer_id"))


def top_order_per_customer(spark, sf_dir):
    """ROW_NUMBER() = 1 by sales DESC per customer, as a min_by aggregate: reduced
    map-side, so a customer with a huge share of lines is not one task's sort."""
    t = Tables(spark, sf_dir)
    lines = S.sales_lines(t)
    best = lines.groupBy("customer_id").agg(F.min_by(
        F.struct("order_id", "line_no", "product_id", "sales"),
        F.struct((-F.col("sales")).alias("s"), F.col("order_id").alias("o"),
                 F.col("line_no").alias("l"), F.col("product_id").alias("p"),
                 F.col("supplier_id").alias("u"), F.col("quantity").alias("q"),
                 F.col("discount").alias("d"))).alias("b"))
    best = best.select("customer_id", "b.*")
    return (best.join(S.product_dim(t), "product_id")
                .join(S.customer_dim(t), "customer_id")
                .select("customer_id", "customer_name", "segment", "order_id", "line_no",
                        F.col("sales").alias("highest_order_value"), "product_name", "category")
                .orderBy(F.desc("highest_order_value"), "customer_id"))


def top_k_orders(spark, sf_dir):
    """ORDER BY sales DESC LIMIT 10 -> TakeOrderedAndProject (distributed top-k)."""
    t = Tables(spark, sf_dir)
    return (S.sales_lines(t).select("order_id", "line_no", "customer_id", "sales")
            .orderBy(F.desc("sales"), "order_id", "line_no").limit(10))


# ---------------------------------------------------------------------------
# star normalisation of the wide fact
# ---------------------------------------------------------------------------

def star_dim_customer(spark, sf_dir):
    """DISTINCT customer attributes of the fact = customers that occur in it (semi join on
    the distinct keys; attributes come from the dimension, never from 600M fact rows).
    The keys are de-duplicated first: partial aggregation collapses a customer that owns a
    third of the fact map-side, since AQE cannot split the right side of a semi join."""
    t = Tables(spark, sf_dir)
    # customers of orders that have a line: the fact itself is never built
    with_lines = t.lineitem("l_orderkey").distinct()
    o = t.orders("o_orderkey", "o_custkey")
    keys = o.join(with_lines, o.o_orderkey == with_lines.l_orderkey, "left_semi") \
        .select(F.col("o_custkey").alias("customer_id")).distinct()
    return S.customer_dim(t).join(keys, "customer_id", "left_semi")


def star_dim_product(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem("l_orderkey", "l_partkey")
    o = t.orders("o_orderkey")
    keys = li.join(o, li.l_orderkey == o.o_orderkey, "left_semi") \
        .select(F.col("l_partkey").alias("product_id")).distinct()
    return S.product_dim(t).join(keys, "product_id", "left_semi")


def star_fact(spark, sf_dir):
    from tallyspark.functions.money import from_cents, profit_units
    t = Tables(spark, sf_dir)
    lines = S.sales_lines(t)
    p = t.part("p_partkey", "p_retailprice")
    return lines.join(p, lines.product_id == p.p_partkey).select(
        "order_id", "line_no", "order_date", "customer_id", "product_id", "sales", "quantity",
        "discount",
        from_cents(profit_units("sales", "discount", "quantity", "p_retailprice"), 4)
        .cast("double").alias("profit"))


def dim_key_conflicts(spark, sf_dir):
    """Keys of a would-be dimension that carry more than one attribute tuple (the load
    would break the primary key).  Product name -> (category, sub-category) here."""
    t = Tables(spark, sf_dir)
    d = S.product_dim(t)
    return (d.groupBy("product_name")
             .agg(F.count_distinct(F.struct("category", "sub_category")).alias("variants"))
             .filter(F.col("variants") > 1))


def buyer_type(spark, sf_dir):
    m = S.customer_sales(Tables(spark, sf_dir))
    return m.select("customer_id", "total_orders", tiers.buyer_type("total_orders").alias("buyer_type"))


def sales_tier(spark, sf_dir):
    m = _with_avg(S.customer_sales(Tables(spark, sf_dir)))
    above = F.col("total_sales_dec") * F.col("n_cust") > F.col("sum_all")
    return m.select("customer_id", F.col("total_sales_dec").cast("double").alias("total_sales"),
                    tiers.sales_tier(above).alias("sales_tier"))
