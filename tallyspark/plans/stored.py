"""Queries over stored, derived structures: sketches, customer states, digests, layouts, histories."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.money import cents, from_cents
from tallyspark.operators import digest as D
from tallyspark.operators import history as H
from tallyspark.operators import lattice as Y
from tallyspark.operators import sketches as K
from tallyspark.operators.materialize import materialize
from tallyspark.plans import incremental as I
from tallyspark.plans.sales import dashboard
from tallyspark.session import scratch_root
from tallyspark.sources import files as FS
from tallyspark.sources import layout as L
from tallyspark.sources import ledger as LG
from tallyspark.sources import standins as S
from tallyspark.sources.tables import Tables

# --- sketches by day --------------------------------------------------------------------------

MEDIAN, UPPER = 0.5, 0.9
RANGE = ("1995-03-10", "1996-08-20")    # a range of days that is no whole number of months


def _order_days(t: Tables) -> DataFrame:
    return t.orders("o_custkey", "o_totalprice", "o_orderdate").withColumn("day", F.col("o_orderdate").cast("date"))


def order_sketches(t: Tables) -> DataFrame:
    """The stored sketches: a row a day."""
    return materialize(K.sketched(_order_days(t), F.col("day"), {"customers": F.col("o_custkey")},
                                  {"price": F.col("o_totalprice")}))


def _checked(estimates: DataFrame, orders: DataFrame, by: str) -> DataFrame:
    """Estimates beside what they stand for: whether they keep their bounds, by group."""
    qs = F.broadcast(estimates.select(by, F.col("price")[0].alias("q1"), F.col("price")[1].alias("q2")))
    exact = orders.join(qs, by).groupBy(by).agg(
        F.count_distinct("o_custkey").alias("exact"), F.count(F.lit(1)).alias("n"),
        *[F.sum((F.col("o_totalprice") < F.col(q)).cast("long")).alias(f"below_{q}") for q in ("q1", "q2")],
        *[F.sum((F.col("o_totalprice") <= F.col(q)).cast("long")).alias(f"upto_{q}") for q in ("q1", "q2")])
    return estimates.join(exact, by).select(
        by, F.col("n_rows").alias("orders"), K.within(F.col("customers"), F.col("exact")).alias("customers_within"),
        *[K.rank_within(F.col(f"below_{q}"), F.col(f"upto_{q}"), F.col("n"), share).alias(name)
          for q, share, name in (("q1", MEDIAN, "median_within"), ("q2", UPPER, "upper_within"))])


def sketch_months(spark, sf_dir):
    """Months merged from the stored days: the orders, and whether distinct customers, median and 90 %
    quantile keep their bounds against exact results."""
    t = Tables(spark, sf_dir)
    month = F.trunc("day", "month").alias("month")
    estimates = K.merged(order_sketches(t), [month], ["customers"], {"price": [MEDIAN, UPPER]})
    return _checked(estimates, _order_days(t).withColumn("month", month), "month").orderBy("month")


def sketch_range(spark, sf_dir):
    """Any range of days from the same stored rows."""
    t = Tables(spark, sf_dir)
    inside = F.col("day").between(*[F.lit(d).cast("date") for d in RANGE])
    one = F.lit("range").alias("span")
    estimates = K.merged(order_sketches(t).filter(inside), [one], ["customers"], {"price": [MEDIAN, UPPER]})
    return _checked(estimates, _order_days(t).filter(inside).withColumn("span", one), "span")


# --- states by version --------------------------------------------------------------------------

def _fact(t: Tables) -> DataFrame:
    cost = t.part("p_partkey", "p_retailprice")
    lines = S.sales_lines(t).join(cost, F.col("product_id") == F.col("p_partkey"))
    return lines.select("line_no", "order_id", "customer_id", "order_date", "product_id", "sales", "quantity", "discount",
                        F.col("p_retailprice").alias("unit_cost"))


def dashboard_batches(t: Tables, root: str) -> None:
    """Three batches: most lines, then late lines of known orders, then new orders."""
    fact = _fact(t)
    late = (F.col("order_id") % 10 == 0) & (F.col("line_no") > 2)
    fresh = F.col("order_id") % 10 == 5
    for rows in (fact.filter(~late & ~fresh), fact.filter(late), fact.filter(fresh)):
        I.add_batch(t.spark, root, rows.drop("line_no"))


def dashboard_incremental(spark, sf_dir):
    """The customer dashboard after three published batches, from the customers' states alone."""
    t = Tables(spark, sf_dir)
    root = scratch_root(spark)
    dashboard_batches(t, root)
    return dashboard(I.customer_totals(spark, root), S.customer_dim(t))


# --- digests --------------------------------------------------------------------------------------

# The lines that a damaged copy has lost, and those it has twice.
LOST, TWICE = (1009, 3, 1), (1013, 5, 2)


def copy_damage(spark, sf_dir):
    """The lines in which a damaged copy differs from its source, found by digests of key ranges."""
    t = Tables(spark, sf_dir)
    src = t.lineitem()

    def hit(rule):
        return (F.col("l_orderkey") % rule[0] == rule[1]) & (F.col("l_linenumber") == rule[2])
    out = scratch_root(spark)
    FS.write_parquet(src.filter(~hit(LOST)).unionAll(src.filter(hit(TWICE))), out)
    found = D.find_damage(src, spark.read.schema(src.schema).parquet(out), "l_orderkey")
    return found.rows.select("l_orderkey", "l_linenumber", "l_partkey", "in_source", "in_copy")


# --- layouts ----------------------------------------------------------------------------------------

BUCKETS = 16


def bucketed_tables(t: Tables, buckets: int = BUCKETS, split: int = 1) -> tuple[DataFrame, DataFrame]:
    """Orders and their lines as named tables bucketed by order key."""
    db = f"tally_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_root(t.spark)}'")
    orders = t.orders("o_orderkey", "o_custkey")
    lines = t.lineitem("l_orderkey", "l_extendedprice")
    L.write_bucketed(orders, f"{db}.orders", scratch_root(t.spark), ["o_orderkey"], buckets, split)
    L.write_bucketed(lines, f"{db}.lines", scratch_root(t.spark), ["l_orderkey"], buckets, split)
    return t.spark.table(f"{db}.orders"), t.spark.table(f"{db}.lines")


def bucketed_join(spark, sf_dir):
    """Sales by customer over co-bucketed tables: lines are added up and joined to their orders where they
    lie; only the customers' partial sums move."""
    orders, lines = bucketed_tables(Tables(spark, sf_dir))
    per = lines.groupBy("l_orderkey").agg(F.sum(cents("l_extendedprice")).alias("c"), F.count(F.lit(1)).alias("n"))
    joined = per.join(orders.hint("merge"), per["l_orderkey"] == orders["o_orderkey"])
    return joined.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        from_cents(F.sum("c")).cast("double").alias("total_sales"), F.sum("n").alias("n_lines"))


CLUSTER_FILES = 32


def clustered_lines(t: Tables) -> DataFrame:
    """Lines in files of neighbours by ship date, part and price."""
    out = scratch_root(t.spark)
    rows = t.lineitem("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    L.write_clustered(rows, out, ["l_shipdate", "l_partkey", "l_extendedprice"], CLUSTER_FILES, {"l_suppkey": 10_000})
    return t.spark.read.schema(rows.schema).parquet(out)


# One selective predicate on each clustered column, and one lookup by value.
SELECTIVE = {"dates": "l_shipdate >= TIMESTAMP_NTZ '1995-06-01' AND l_shipdate < TIMESTAMP_NTZ '1995-07-01'",
             "parts": "l_partkey BETWEEN 5 AND 40", "prices": "l_extendedprice < 1500", "supplier": "l_suppkey = 7"}


def clustered_scan(spark, sf_dir):
    """Rows and their sales by four selective predicates, each on another column of the clustered table."""
    lines, out = clustered_lines(Tables(spark, sf_dir)), None
    for name, predicate in SELECTIVE.items():
        one = lines.filter(predicate).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(cents("l_extendedprice")), F.lit(0)).alias("c"))
        part = one.select(F.lit(name).alias("predicate"), "n", from_cents(F.col("c")).cast("double").alias("sales"))
        out = part if out is None else out.unionByName(part)
    return out


# --- dimension history --------------------------------------------------------------------------------

ATTRIBUTES = ["segment", "region"]


def customer_history(spark, sf_dir):
    """Versions of customers whose segment or region changes over the fact's dates."""
    fact = S.drifting_sales(Tables(spark, sf_dir))
    return H.versions(fact, "customer_id", ATTRIBUTES, "order_date")


def customer_current(spark, sf_dir):
    """One row a customer where the fact's attributes conflict: the state of the last day."""
    fact = S.drifting_sales(Tables(spark, sf_dir))
    return H.current(fact, "customer_id", ATTRIBUTES, "order_date")


def sales_by_valid_segment(spark, sf_dir):
    """Sales by the segment that was valid on the order's day, and by version number."""
    fact = S.drifting_sales(Tables(spark, sf_dir))
    at = H.as_of(fact, "customer_id", ATTRIBUTES, "order_date")
    return at.groupBy("valid_segment", "version").agg(
        from_cents(F.sum(cents("sales"))).cast("double").alias("total_sales"), F.count(F.lit(1)).alias("n_lines"))


# --- types with evidence ----------------------------------------------------------------------------------

def column_types(spark, sf_dir):
    """The type that the values of each text column agree on."""
    return Y.chosen(Y.evidence(S.text_orders(Tables(spark, sf_dir))))


def column_type_evidence(spark, sf_dir):
    """For each column and candidate type: the share of values that fit and the smallest that doesn't."""
    found = Y.evidence(S.text_orders(Tables(spark, sf_dir)))
    return found.select("column_name", "candidate", "n_values", "n_fit",
                        F.try_divide("n_fit", "n_values").alias("share"), "example")


# --- copy by ledger -----------------------------------------------------------------------------------------

COPY_FILES = 8


class Stopped(RuntimeError):
    """The copy was cut off."""


def _copied(spark, sf_dir) -> tuple[str, list[tuple]]:
    """Five runs over customers in COPY_FILES files: one cut off after its second batch, one that goes on, one with
    nothing to do, one after a file changed, one after a file went."""
    customers = Tables(spark, sf_dir).customer()
    src, dst, runs = scratch_root(spark), scratch_root(spark), []
    customers.repartitionByRange(COPY_FILES, "c_custkey").write.parquet(src)

    def cut(number):
        if number == 2:
            raise Stopped
    files = sorted(LG.source_files(spark, src))
    largest = max(size for size, _ in LG.source_files(spark, src).values())

    def run(**kw):
        before = LG.read_ledger(spark, dst)[0]
        try:
            done = LG.sync(spark, src, dst, customers.schema, **kw)
        except Stopped:
            done = {"files_copied": LG.read_ledger(spark, dst)[0] - before, "files_left": 0, "files_gone": 0}
        runs.append((len(runs) + 1, *done.values()))
    run(batch_bytes=largest, after_batch=cut)
    run()
    run()
    # the last file changes: its customers' balances go up by one
    fs, last = FS.file_system(spark, files[-1])
    changed = scratch_root(spark)
    spark.read.schema(customers.schema).parquet(files[-1]).withColumn("c_acctbal", F.col("c_acctbal") + 1) \
        .coalesce(1).write.parquet(changed)
    (part,) = LG.source_files(spark, changed)
    fs.delete(last, False)
    fs.rename(FS.file_system(spark, part)[1], last)
    run()
    fs.delete(FS.file_system(spark, files[0])[1], False)
    run()
    return dst, runs


def copy_ledger_runs(spark, sf_dir):
    """What each run copied, left alone and took out."""
    _, runs = _copied(spark, sf_dir)
    return spark.createDataFrame(runs, "run int, files_copied int, files_left int, files_gone int")


def copy_ledger(spark, sf_dir):
    """The copy after the five runs: the rows of the files that are there, each once; how many of them hold the
    changed balance."""
    t = Tables(spark, sf_dir)
    dst, _ = _copied(spark, sf_dir)
    copy = LG.read_copy(spark, dst, t.customer().schema)
    was = t.customer("c_custkey", "c_acctbal").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("was"))
    both = copy.join(was, copy["c_custkey"] == was["k"], "full")
    return both.agg(F.count("c_custkey").alias("n_rows"), F.count_distinct("c_custkey").alias("n_keys"),
                    (F.max("k") == F.max(F.when(F.round(F.col("c_acctbal") - F.col("was"), 2) == 1, F.col("k")))).alias("change_seen"),
                    F.min(F.when(F.col("c_custkey").isNull(), F.col("k"))).alias("first_gone")) \
        .select(F.col("n_rows") == F.col("n_keys"), "change_seen", "first_gone").toDF("each_once", "change_seen", "first_gone")


QUERIES = {
    "column_types": column_types,
    "column_type_evidence": column_type_evidence,
    "copy_ledger_runs": copy_ledger_runs,
    "copy_ledger": copy_ledger,
    "sketch_months": sketch_months,
    "sketch_range": sketch_range,
    "dashboard_incremental": dashboard_incremental,
    "copy_damage": copy_damage,
    "bucketed_join": bucketed_join,
    "clustered_scan": clustered_scan,
    "customer_history": customer_history,
    "customer_current": customer_current,
    "sales_by_valid_segment": sales_by_valid_segment,
}
