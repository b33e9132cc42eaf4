"""Physical-plan properties that matter at scale (checked on the smallest tables)."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, key):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    p = _plan(spark, "pushdown_scan")
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_shipdate), EqualTo(l_returnflag,R), " \
           "GreaterThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double," \
           "l_returnflag:string,l_shipdate:timestamp_ntz>" in p


def test_year_filter_is_a_pushed_range(spark):
    p = _plan(spark, "filter_date_halfopen")
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in p and "LessThan(o_orderdate,1998-01-01T00:00)" in p


def test_partition_pruning(spark):
    assert "PartitionFilters: [isnotnull(department" in _plan(spark, "partitioned_roundtrip")
    assert "(department" in _plan(spark, "partitioned_roundtrip").split("PartitionFilters:")[1][:120]


def test_anti_joins(spark):
    for key in ("orphan_items", "orders_without_items"):
        assert "LeftAnti" in _plan(spark, key)


@pytest.mark.parametrize("key", ["rank_customers", "dense_rank_customers", "customer_quartile",
                                 "customer_scorecard", "customer_dashboard", "dense_row_id",
                                 "order_sequence", "top_order_per_customer"])
def test_no_single_partition_over_rows(spark, key):
    assert "SinglePartition" not in _plan(spark, key)


def test_pre_aggregation_before_join(spark):
    p = _plan(spark, "revenue_by_category")
    # line items are aggregated per part key (partial + final) below the part join
    # (the tree string lists parents before children)
    join_at = min(i for i in (p.find("BroadcastHashJoin"), p.find("SortMergeJoin")) if i >= 0)
    assert p.find("HashAggregate(keys=[l_partkey", join_at) > join_at


def test_top_order_uses_aggregate_not_window(spark):
    p = _plan(spark, "top_order_per_customer")
    assert "min_by" in p and "Window" not in p


def test_the_job_that_writes_the_dashboard_totals(spark):
    """Each table is read once, and the totals are moved once more: into sales order."""
    from tallyspark.operators.ranking import ordered_plan
    from tallyspark.plans.sales import BY_SALES
    from tallyspark.session import plan_text
    from tallyspark.sources import standins as S
    from tallyspark.sources.tables import Tables
    p = plan_text(ordered_plan(S.twin_sales(Tables(spark, SF), with_profit=True), BY_SALES), "simple")
    assert p.count("FileScan parquet") == 3
    assert p.count("Exchange rangepartitioning") == 1 and "SinglePartition" not in p


def test_small_dimensions_are_broadcast(spark):
    from tallyspark.session import plan_text
    from tallyspark.sources import standins as S
    from tallyspark.sources.tables import Tables
    assert plan_text(S.customer_dim(Tables(spark, SF))).count("BroadcastHashJoin") >= 2


def test_above_average_lines_are_joined_once(spark):
    from tallyspark.session import plan_text
    from tallyspark.plans.sales import above_avg_orders
    p = plan_text(above_avg_orders(spark, SF), "simple")   # the written lines and two dimensions
    assert p.count("lineitem.parquet") == 0 and p.count("FileScan parquet") == 5
