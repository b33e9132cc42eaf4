"""Reference entities expressed over the benchmark tables.

| reference entity            | derived from                                             |
|-----------------------------|----------------------------------------------------------|
| sales line (wide fact row)  | lineitem joined to orders (customer, date)               |
| customer dimension          | customer joined to nation and region                     |
| product dimension           | part                                                     |
| staff record                | customer (+ nation, region), attributes by expression    |
| dirty orders / dirty staff  | deterministic nulls and extra duplicate rows by key      |

Every view reads whole tables; derived dirt is a pure function of the row key, so the
same rows are dirty in Spark and in the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.money import cents, from_cents, money, profit_units
from tallyspark.sources.tables import Tables

# The key rules that make stand-in rows dirty (null / duplicate / re-keyed).
DIRTY_PRICE_MOD, DIRTY_PRICE_REM = 35, 0
DIRTY_PRIORITY_MOD, DIRTY_PRIORITY_REM = 40, 1
DIRTY_STATUS_MOD, DIRTY_STATUS_REM = 25, 2
DIRTY_QTY_MOD, DIRTY_QTY_REM = 45, 3
DUPLICATE_MOD = 21
TEXT_JUNK_MOD = 13
AUDIT_STATUS = (53, 7, "X")             # orders with a status outside the domain
AUDIT_CUSTOMER = (61, 5, 1_000_000_000)  # orders whose customer doesn't exist (key shifted by)
AUDIT_ORPHAN = (47, 9)                  # first lines of such orders name an order that doesn't exist
AUDIT_NO_LINES = (59, 4)                # orders that have lost their lines
AUDIT_NO_ORDERS = (10, 3)               # customers whose orders are left out
TWINS = (3, 1, 1_000_000_000, " (twin)")  # customers with a twin of the same sales: key shifted by, name
DRIFT = (4, 1, "1995-01-01", "1997-01-01", "MOVED", 6, 2)  # customers who change segment on the first
#                                         day and back on the second; orders % 6 = 2 show an old region
REPEATED = (7, 3, 100)                  # orders whose lines were entered twice: line numbers shifted by
TEXT_RULES = (7, 0, 1, 2)               # page keys whose text is NULL, empty, full of backslashes
STAFF_SALARY_NULL = (35, 0)
STAFF_RATING_NULL = (40, 1)
STAFF_REGION_NULL = (25, 2)
STAFF_AGE_NULL = (45, 3)
STAFF_EXPERIENCE_NULL = (50, 4)
STAFF_REKEY_MOD = 23
STAFF_REKEY_OFFSET = 1_000_000_000_000
STAFF_JOIN_BASE = "2015-01-01"


def _key_is(c, mod_rem):
    mod, rem = mod_rem
    return (F.col(c) % mod) == rem


def sales_lines(t: Tables) -> DataFrame:
    """One row per line item with its order's customer and date (the A3 'orders' grain)."""
    li = t.lineitem("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    "l_quantity", "l_extendedprice", "l_discount")
    o = t.orders("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_extendedprice").alias("sales"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
    )


def order_sales(t: Tables, with_profit: bool = False) -> DataFrame:
    """Line items pre-aggregated per order, then attached to the order header.

    Aggregating lineitem by order key *before* joining orders shrinks the join input to
    order grain and turns COUNT(DISTINCT order) per customer into a plain count.
    """
    li = t.lineitem("l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_quantity")
    # exact fixed-point sums in BIGINT: cents for sales, 1e-4 units for profit
    aggs = [F.sum(cents("l_extendedprice")).alias("sales_cents"),
            F.count(F.lit(1)).alias("n_lines"),
            F.max("l_extendedprice").alias("max_line_sales")]
    if with_profit:
        p = t.part("p_partkey", "p_retailprice")
        li = li.join(p, li.l_partkey == p.p_partkey)
        aggs.append(F.sum(profit_units("l_extendedprice", "l_discount", "l_quantity",
                                       "p_retailprice")).alias("profit_units"))
    per_order = li.groupBy("l_orderkey").agg(*aggs)
    o = t.orders("o_orderkey", "o_custkey", "o_orderdate")
    return per_order.join(o, per_order.l_orderkey == o.o_orderkey).drop("l_orderkey")


def customer_sales(t: Tables, with_profit: bool = False) -> DataFrame:
    """Per-customer totals: exact decimal sums, order count, line count, extremes."""
    per_order = order_sales(t, with_profit)
    aggs = [from_cents(F.sum("sales_cents")).alias("total_sales_dec"),
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("n_lines").alias("n_lines"),
            F.max("max_line_sales").alias("max_single_order"),
            F.min("o_orderdate").cast("date").alias("first_order"),
            F.max("o_orderdate").cast("date").alias("last_order")]
    if with_profit:
        aggs.append(from_cents(F.sum("profit_units"), 4).alias("total_profit_dec"))
    return per_order.groupBy(F.col("o_custkey").alias("customer_id")).agg(*aggs)


def _again(df: DataFrame, key: str, rule, number: str, shift: int) -> DataFrame:
    """``df`` with a second row, ``number`` shifted, for each row whose ``key`` meets the rule."""
    both = F.array(F.col(number), (F.col(number) + shift).cast(df.schema[number].dataType))
    return df.withColumn(number, F.explode(F.when(_key_is(key, rule), both).otherwise(F.array(number))))


def twin_sales(t: Tables, with_profit: bool = False) -> DataFrame:
    """``customer_sales`` with the twins, whose totals tie."""
    return _again(customer_sales(t, with_profit), "customer_id", TWINS[:2], "customer_id", TWINS[2])


def twin_dim(t: Tables) -> DataFrame:
    """``customer_dim`` with the twins."""
    both = _again(customer_dim(t).withColumn("first", F.col("customer_id")), "customer_id", TWINS[:2],
                  "customer_id", TWINS[2])
    twin = F.col("customer_id") != F.col("first")
    return both.withColumn("customer_name", F.concat("customer_name", F.when(twin, TWINS[3]).otherwise(""))).drop("first")


def repeated_lines(t: Tables) -> DataFrame:
    """``sales_lines`` with lines that were entered twice, whose sales tie."""
    return _again(sales_lines(t), "order_id", REPEATED[:2], "line_no", REPEATED[2])


def drifting_sales(t: Tables) -> DataFrame:
    """Sales lines with the customer attributes that they show: some customers change their segment and
    back, and some of their orders show another region than the rest of the day."""
    mod, rem, first, second, name, order_mod, order_rem = DRIFT
    lines = sales_lines(t).join(customer_dim(t).select("customer_id", "segment", "region"), "customer_id")
    moves = _key_is("customer_id", (mod, rem))
    away = moves & (F.col("order_date") >= F.lit(first).cast("date")) & (F.col("order_date") < F.lit(second).cast("date"))
    odd = moves & _key_is("order_id", (order_mod, order_rem))
    return lines.withColumns({"segment": F.when(away, F.lit(name)).otherwise(F.col("segment")),
                              "region": F.when(odd, F.upper(F.concat("region", F.lit("*")))).otherwise(F.col("region"))})


def text_orders(t: Tables) -> DataFrame:
    """Orders as text columns of several types, some with values that don't fit the rest."""
    key, price = F.col("o_orderkey"), money("o_totalprice").cast("string")
    day = F.col("o_orderdate").cast("date")
    return t.orders().select(
        key.cast("string").alias("whole"), (key * 10_000_000_000).cast("string").alias("large"), price.alias("price"),
        F.when(key % 3 == 0, F.concat(price, F.lit("e-3"))).otherwise(price).alias("ratio"),
        F.when(key % 9 == 0, "").otherwise(day.cast("string")).alias("day"),
        F.date_format(day, "dd/MM/yyyy").alias("day_first"),
        F.when(key % 997 == 5, "unknown").otherwise(day.cast("string")).alias("dirty_day"),
        (key % 2 == 0).cast("string").alias("flag"), F.when(key % 991 == 7, "n/a").otherwise(key.cast("string")).alias("dirty"),
        F.lit(None).cast("string").alias("nothing"))


def customer_dim(t: Tables) -> DataFrame:
    c = t.customer("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = t.nation("n_nationkey", "n_name", "n_regionkey")
    r = t.region("r_regionkey", "r_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("c_custkey").alias("customer_id"),
                     F.col("c_name").alias("customer_name"),
                     F.col("c_mktsegment").alias("segment"),
                     F.col("n_name").alias("country"),
                     F.col("r_name").alias("region")))


def product_dim(t: Tables) -> DataFrame:
    return t.part("p_partkey", "p_name", "p_type", "p_brand").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"))


def staff(t: Tables, dirty: bool = False) -> DataFrame:
    """Staff records: one per customer.  salary = 10 * account balance + 50,000 (exact)."""
    c = t.customer("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = t.nation("n_nationkey", "n_name", "n_regionkey")
    r = t.region("r_regionkey", "r_name")
    k = F.col("c_custkey")
    base = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(
                k.alias("emp_id"),
                F.col("c_name").alias("name"),
                (22 + k % 40).cast("int").alias("age"),
                F.col("c_mktsegment").alias("department"),
                (money("c_acctbal") * 10 + 50000).cast("double").alias("salary"),
                F.col("r_name").alias("region"),
                F.col("n_name").alias("city"),
                F.date_add(F.lit(STAFF_JOIN_BASE).cast("date"), ((k * 37) % 3650).cast("int"))
                 .alias("joining_date"),
                (k % 16).cast("int").alias("experience_years"),
                (F.lit(3.0) + (k % 20).cast("double") / 10.0).alias("rating"),
            ))
    if not dirty:
        return base
    e = "emp_id"
    dirty_rows = base.select(
        e, "name",
        F.when(_key_is(e, STAFF_AGE_NULL), None).otherwise(F.col("age")).alias("age"),
        "department",
        F.when(_key_is(e, STAFF_SALARY_NULL), None).otherwise(F.col("salary")).alias("salary"),
        F.when(_key_is(e, STAFF_REGION_NULL), None).otherwise(F.col("region")).alias("region"),
        "city", "joining_date",
        F.when(_key_is(e, STAFF_EXPERIENCE_NULL), None).otherwise(F.col("experience_years"))
         .alias("experience_years"),
        F.when(_key_is(e, STAFF_RATING_NULL), None).otherwise(F.col("rating")).alias("rating"),
    )
    # extra rows are generated in the same scan: 0 = the row, 1 = exact copy, 2 = re-keyed
    # copy; absent copies are NULL slots dropped right after the explode (no lambda
    # function, so the scan stays in whole-stage codegen)
    k = F.col(e)
    copies = F.array(F.lit(0), F.when(k % DUPLICATE_MOD == 0, F.lit(1)),
                     F.when(k % STAFF_REKEY_MOD == 0, F.lit(2)))
    return (dirty_rows.withColumn("_copy", F.explode(copies)).filter(F.col("_copy").isNotNull())
            .withColumn(e, F.when(F.col("_copy") == 2, k + STAFF_REKEY_OFFSET).otherwise(k))
            .drop("_copy"))


def dirty_orders(t: Tables) -> DataFrame:
    """Orders with deterministic nulls, a numeric column kept as text with junk values,
    a derived quantity, and exact duplicate rows appended."""
    o = t.orders("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                 "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    rows = o.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(k % DIRTY_STATUS_MOD == DIRTY_STATUS_REM, None).otherwise(F.col("o_orderstatus"))
         .alias("status"),
        F.when(k % DIRTY_PRICE_MOD == DIRTY_PRICE_REM, None).otherwise(F.col("o_totalprice"))
         .alias("price"),
        F.when(k % DIRTY_QTY_MOD == DIRTY_QTY_REM, None).otherwise((k % 9 + 1).cast("int"))
         .alias("quantity"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(k % DIRTY_PRIORITY_MOD == DIRTY_PRIORITY_REM, None)
         .otherwise(F.col("o_orderpriority")).alias("category"),
        F.when(k % TEXT_JUNK_MOD == 0, F.lit("n/a"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("price_text"),
    )
    copies = F.array(F.lit(0), F.when(F.col("order_id") % DUPLICATE_MOD == 0, F.lit(1)))
    return rows.withColumn("_copy", F.explode(copies)).filter(F.col("_copy").isNotNull()) \
        .drop("_copy")


def measures(t: Tables) -> DataFrame:
    """Orders as measurements: a DOUBLE with many decimals and two DECIMALs, NULL on some keys."""
    o = t.orders("o_orderkey", "o_totalprice", "o_orderpriority")
    k, amount = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(10,2)")
    return o.select(
        k.alias("order_id"),
        F.when(k % DIRTY_PRICE_MOD == 1, None).otherwise(F.col("o_totalprice") / 7000).alias("ratio"),
        F.when(k % DIRTY_QTY_MOD == 2, None).otherwise(amount).alias("amount"),
        F.when(k % DIRTY_STATUS_MOD == 3, None)
         .otherwise((amount * F.lit("0.0125").cast("decimal(5,4)")).cast("decimal(12,4)")).alias("unit"),
        F.when(k % DIRTY_PRIORITY_MOD == 4, None).otherwise(F.col("o_orderpriority")).alias("priority"))


def audit_orders(t: Tables) -> DataFrame:
    """Orders with planted faults: statuses outside the domain, customers that don't exist."""
    k = F.col("o_orderkey")
    mod, rem, status = AUDIT_STATUS
    c_mod, c_rem, shift = AUDIT_CUSTOMER
    return t.orders().withColumns({
        "o_orderstatus": F.when(k % mod == rem, status).otherwise(F.col("o_orderstatus")),
        "o_custkey": F.when(k % c_mod == c_rem, F.col("o_custkey") + shift).otherwise(F.col("o_custkey"))})


def audit_lines(t: Tables, *columns: str) -> DataFrame:
    """Line items with planted faults: lines of orders that don't exist, orders without lines."""
    li = t.lineitem(*dict.fromkeys(("l_orderkey", "l_linenumber", *columns)))
    k = F.col("l_orderkey")
    orphan = (k % AUDIT_ORPHAN[0] == AUDIT_ORPHAN[1]) & (F.col("l_linenumber") == 1)
    return (li.filter(k % AUDIT_NO_LINES[0] != AUDIT_NO_LINES[1])
            .withColumn("l_orderkey", F.when(orphan, -k).otherwise(k)))


def orders_of_some(t: Tables, *columns: str) -> DataFrame:
    """Orders without those of the customers that are left out."""
    mod, rem = AUDIT_NO_ORDERS
    return t.orders(*columns).filter(F.col("o_custkey") % mod != rem)


def awkward_text(t: Tables) -> DataFrame:
    """Page sources (quotes, commas, line breaks) with backslashes, empty texts and NULLs."""
    mod, null, empty, slashes = TEXT_RULES
    k = F.col("page_id") % mod
    text = (F.when(k == null, None).when(k == empty, "")
            .when(k == slashes, F.concat(F.lit('\\ "\\" ,\r\n '), F.col("html"), F.lit(" \\")))
            .otherwise(F.col("html")))
    return t.pages("page_id", "url", "html").select("page_id", "url", text.alias("text"))
