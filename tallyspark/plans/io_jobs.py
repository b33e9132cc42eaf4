"""File round trips, partitioned layout, metadata, guarded copies, versioned publish,
validation split and the data-quality suite.  Every job writes under the shared scratch
root (a fresh folder per call) and returns the DataFrame read back from what it wrote."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators import quality as Q
from tallyspark.operators.materialize import materialize
from tallyspark.plans.retail import STATUS_LABELS, _new_orders, agg_by_status
from tallyspark.session import scratch_root
from tallyspark.sources import files as FS
from tallyspark.sources import standins as S
from tallyspark.sources import versions as V
from tallyspark.sources.tables import SCHEMAS, TABLES, Tables, table_path


TEXT_SCHEMA = "page_id bigint, url string, text string"


def csv_schema_roundtrip(spark, sf_dir):
    """Text with quotes, commas, backslashes, line breaks, empty strings and NULLs, through CSV
    and back."""
    out = scratch_root(spark)
    FS.write_csv(S.awkward_text(Tables(spark, sf_dir)), out, null_value=FS.NULL_TEXT)
    return FS.read_csv(spark, out, schema=TEXT_SCHEMA, null_value=FS.NULL_TEXT, mode="FAILFAST")


def csv_infer_roundtrip(spark, sf_dir):
    out = scratch_root(spark)
    FS.write_csv(Tables(spark, sf_dir).customer(), out)
    return FS.read_csv(spark, out, infer=True)


def parquet_roundtrip(spark, sf_dir):
    out = scratch_root(spark)
    FS.write_parquet(Tables(spark, sf_dir).lineitem(), out)
    return spark.read.parquet(out)


WIDE_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("line_no", T.IntegerType()),
    T.StructField("order_date", T.DateType()), T.StructField("customer_id", T.LongType()),
    T.StructField("customer_name", T.StringType()), T.StructField("segment", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("region", T.StringType()),
    T.StructField("product_id", T.LongType()), T.StructField("category", T.StringType()),
    T.StructField("sub_category", T.StringType()), T.StructField("product_name", T.StringType()),
    T.StructField("sales", T.DecimalType(10, 2)), T.StructField("quantity", T.IntegerType()),
    T.StructField("discount", T.DecimalType(4, 2))])


def _wide_fact(t: Tables) -> DataFrame:
    lines = S.sales_lines(t)
    return (lines.join(S.customer_dim(t), "customer_id").join(S.product_dim(t), "product_id")
                 .select("order_id", "line_no", "order_date", "customer_id", "customer_name",
                         "segment", "country", "region", "product_id", "category", "sub_category",
                         "product_name", "sales", F.col("quantity").cast("int").alias("quantity"),
                         "discount"))


def bulk_load_typed(spark, sf_dir):
    """Wide CSV (header, quoted) -> typed load with the declared table schema (DECIMAL
    money, DATE, INT) -> Parquet table -> read back."""
    t = Tables(spark, sf_dir)
    raw = scratch_root(spark)
    FS.write_csv(_wide_fact(t), raw)
    typed = FS.read_csv(spark, raw, schema=WIDE_SCHEMA, mode="FAILFAST")
    table = scratch_root(spark)
    FS.write_parquet(typed, table)
    loaded = spark.read.parquet(table)
    return loaded.withColumns({"sales": F.col("sales").cast("double"),
                               "discount": F.col("discount").cast("double")})


def csv_single_file(spark, sf_dir):
    """Aggregated result written as ONE CSV file (coalesce(1) after the aggregate only)."""
    out = scratch_root(spark)
    FS.write_csv(agg_by_status(spark, sf_dir), out, single_file=True)
    schema = "status string, order_count bigint, total_revenue double"
    return FS.read_csv(spark, out, schema=T._parse_datatype_string(schema))


def _partitioned_staff(spark, sf_dir) -> str:
    out = scratch_root(spark)
    FS.write_parquet(S.staff(Tables(spark, sf_dir)), out, partition_by="department")
    return out


def partitioned_roundtrip(spark, sf_dir):
    """Partitioned write, then a read whose filter prunes to one partition folder."""
    out = _partitioned_staff(spark, sf_dir)
    return spark.read.parquet(out).filter(F.col("department") == "BUILDING")


def partition_inventory(spark, sf_dir):
    out = _partitioned_staff(spark, sf_dir)
    return spark.read.parquet(out).groupBy("department").agg(F.count(F.lit(1)).alias("row_count"))


def _two_formats(spark, sf_dir) -> tuple[DataFrame, dict[str, str]]:
    o = Tables(spark, sf_dir).orders()
    return o, {"csv": scratch_root(spark), "parquet": scratch_root(spark)}


def _read_format(spark, fmt: str, path: str, schema: T.StructType) -> DataFrame:
    return FS.read_csv(spark, path, schema=schema) if fmt == "csv" else spark.read.schema(schema).parquet(path)


def format_report(spark, sf_dir) -> DataFrame:
    """Same table as CSV and as Parquet: (format, rows, files, bytes, write_s, read_s).  Rows are
    counted by the format's own reader, files and bytes listed; the seconds are wall clock."""
    o, paths = _two_formats(spark, sf_dir)
    rows = []
    for fmt, path in paths.items():
        began = time.perf_counter()
        (FS.write_csv if fmt == "csv" else FS.write_parquet)(o, path)
        written = time.perf_counter()
        n = _read_format(spark, fmt, path, o.schema).agg(F.count("o_orderkey")).first()[0]
        read = time.perf_counter()
        at = FS.file_metadata(spark, [path]).first()
        rows.append((fmt, n, at["n_files"], at["size"], written - began, read - written))
    return spark.createDataFrame(rows, "format string, rows bigint, files bigint, bytes bigint, "
                                       "write_s double, read_s double")


def format_measured(spark, sf_dir):
    """``format_report`` as far as it is the same on every run: the rows of each format, that the files,
    bytes and both times were measured, and that Parquet takes less room than CSV."""
    report = materialize(format_report(spark, sf_dir))
    csv = F.broadcast(report.filter("format = 'csv'").select(F.col("bytes").alias("csv_bytes")))
    return report.crossJoin(csv).select(
        "format", "rows", (F.col("files") > 0).alias("has_files"),
        ((F.col("write_s") > 0) & (F.col("read_s") > 0)).alias("timed"),
        ((F.col("format") == "csv") | (F.col("bytes") < F.col("csv_bytes"))).alias("no_larger_than_csv"))


def format_compare(spark, sf_dir):
    """(format, rows, keys) as each format gives them back."""
    o, paths = _two_formats(spark, sf_dir)
    FS.write_csv(o, paths["csv"])
    FS.write_parquet(o, paths["parquet"])
    a, b = (_read_format(spark, fmt, path, o.schema).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))
        .select(F.lit(fmt).alias("format"), "*") for fmt, path in paths.items())
    return a.unionByName(b)


def file_metadata(spark, sf_dir):
    """(item_name, exists, is_folder) of the tables, a path that isn't there and an empty folder."""
    empty = f"{scratch_root(spark)}/empty_folder"
    fs, path = FS.file_system(spark, empty)
    fs.mkdirs(path)
    paths = [table_path(sf_dir, n) for n in TABLES] + [f"{sf_dir}/no_such_table.parquet", empty]
    return FS.file_metadata(spark, paths).select(
        "item_name", "exists", F.when(F.col("item_name") == "empty_folder", F.col("n_files"))
        .alias("files_in_empty_folder"))


def _copy(spark, sf_dir):
    src = table_path(sf_dir, "supplier")
    dst = scratch_root(spark)
    return src, dst, FS.guarded_copy(spark, src, dst)


def guarded_copy(spark, sf_dir):
    _, dst, report = _copy(spark, sf_dir)
    if report["status"] != "copied":
        return spark.createDataFrame([], SCHEMAS["supplier"])
    return spark.read.parquet(dst)


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """(missing_in_copy, extra_in_copy): both EXCEPT ALL counts from one signed aggregate."""
    signed = a.withColumn("_sign", F.lit(1)).unionByName(b.withColumn("_sign", F.lit(-1)))
    per = signed.groupBy(*a.columns).agg(F.sum("_sign").alias("s"))
    return per.agg(F.coalesce(F.sum(F.greatest("s", F.lit(0))), F.lit(0)).alias("missing_in_copy"),
                   F.coalesce(F.sum(F.greatest(-F.col("s"), F.lit(0))), F.lit(0)).alias("extra_in_copy"))


# The rows a damaged copy has lost, and those it has twice.
LOST_MOD, LOST_REM, TWICE_REM = 11, 3, 5


def copy_verify(spark, sf_dir):
    """A true copy and a damaged one, each held against its source."""
    src, dst, _ = _copy(spark, sf_dir)
    a, b = spark.read.parquet(src), spark.read.parquet(dst)
    key = F.col("s_suppkey") % LOST_MOD
    damaged = scratch_root(spark)
    FS.write_parquet(b.filter(key != LOST_REM).unionAll(b.filter(key == TWICE_REM)), damaged)
    true = differing_rows(a, b).select(F.lit("true").alias("copy"), "*")
    bad = differing_rows(a, spark.read.parquet(damaged)).select(F.lit("damaged").alias("copy"), "*")
    return true.unionByName(bad)


PRICE_SCHEMA = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
                             T.StructField("price", T.DoubleType())])


def copy_report(spark, sf_dir):
    """A CSV source with rows that don't fit the schema: they are counted as skipped."""
    src, dst = scratch_root(spark), scratch_root(spark)
    FS.write_csv(S.dirty_orders(Tables(spark, sf_dir)).select("order_id", "customer_id", "price_text"), src)
    report = FS.guarded_copy(spark, src, dst, fmt="csv", schema=PRICE_SCHEMA)
    return FS.copy_report(spark, report).select("status", "rows_read", "rows_copied", "rows_skipped")


def pushdown_scan(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem()
    return (li.filter((F.col("l_returnflag") == "R")
                      & (F.col("l_shipdate") >= F.lit(dt.datetime(1996, 1, 1)).cast("timestamp_ntz"))
                      & (F.col("l_shipdate") < F.lit(dt.datetime(1997, 1, 1)).cast("timestamp_ntz")))
              .select("l_orderkey", "l_linenumber", "l_extendedprice"))


NEW_LINE_ROWS = [(-1, 1, 1, 1, 1.0, 999.00, 0.0, 0.0, "N", "O", dt.datetime(1998, 8, 3)),
                 (-1, 2, 2, 2, 1.0, 599.00, 0.0, 0.0, "N", "O", dt.datetime(1998, 8, 3))]


def _load_checks(spark, root: str):
    """Order keys are new and unique in the batch (stored keys are looked up, not aggregated anew); the new
    lines reference an existing order; no stock below zero."""
    def check(current, batch):
        orders = batch["orders"]
        again = V.stored_keys(spark, root, "orders", orders.select("o_orderkey"), "o_orderkey")
        key = Q.run_suite(orders, "orders", [Q.Rule("order_key_unique", "unique", "o_orderkey"),
                                             Q.Rule("order_key_new", "new_key", "o_orderkey", parent=(again, "o_orderkey")),
                                             Q.Rule("status_domain", "domain", "o_orderstatus",
                                                    [s for s, _ in STATUS_LABELS])])
        lines = batch["lineitem"]
        known = V.stored_keys(spark, root, "orders", lines.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
        fk = Q.run_suite(lines, "lineitem", [Q.Rule("line_order_fk", "foreign_key", "l_orderkey", parent=(
            known.unionByName(orders.select("o_orderkey")), "o_orderkey"))])
        if "stock" not in batch:
            return key.unionByName(fk)
        stock = Q.run_suite(batch["stock"], "stock", [Q.Rule("stock_left", "check", "stock_qty", "stock_qty >= 0")])
        return key.unionByName(fk).unionByName(stock)
    return check


def _stock(t: Tables) -> DataFrame:
    return t.part("p_partkey", "p_size").select("p_partkey", (F.col("p_size").cast("bigint") * 100).alias("stock_qty"))


STOCK_FILES = 16


def _write_stock(t: Tables) -> str:
    """The stock in files of neighbouring parts, so that an update touches few of them."""
    path = scratch_root(t.spark)
    FS.write_parquet(_stock(t).repartitionByRange(STOCK_FILES, "p_partkey"), path)
    return path


def _take_stock(spark, root: str, lines: DataFrame) -> V.Rewrite | None:
    """UPDATE stock SET stock_qty = stock_qty - sold for the parts of the lines."""
    sold = lines.groupBy(F.col("l_partkey").alias("part")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("sold"))
    return V.update_touched(spark, root, "stock", sold.withColumnRenamed("part", "p_partkey"), "p_partkey",
                            {"stock_qty": F.col("stock_qty") - F.col("new_sold")})


def _loaded(spark, sf_dir, orders: DataFrame, line_rows) -> tuple[str, dict]:
    """A batch over the registered base tables: order headers, their lines and the stock they
    take, published all together or not at all."""
    t = Tables(spark, sf_dir)
    root, stock = scratch_root(spark), _write_stock(t)
    for name, path, schema in (("orders", table_path(sf_dir, "orders"), SCHEMAS["orders"]),
                               ("lineitem", table_path(sf_dir, "lineitem"), SCHEMAS["lineitem"]),
                               ("stock", stock, _stock(t).schema)):
        V.register_base(spark, root, name, path, schema)
    lines = spark.createDataFrame(line_rows, SCHEMAS["lineitem"])
    result = V.publish(spark, root, {"orders": orders, "lineitem": lines}, checks=_load_checks(spark, root),
                       rewrites={"stock": _take_stock(spark, root, lines)}, keys={"orders": "o_orderkey"})
    return root, result


def merge_touched_files(spark, sf_dir):
    """UPDATE of the stock by the lines of a few orders: only the files that hold their parts are written
    anew.  The stock afterwards."""
    t = Tables(spark, sf_dir)
    root = scratch_root(spark)
    V.register_base(spark, root, "stock", _write_stock(t), _stock(t).schema)
    lines = t.lineitem("l_orderkey", "l_partkey", "l_quantity").filter(F.col("l_orderkey") < 3)
    V.publish(spark, root, {}, rewrites={"stock": _take_stock(spark, root, lines)})
    return V.resolve(spark, root, "stock")


KEY_VERSIONS = 4
BATCH_MOD = 50                  # every 50th order key is sent again, and a new one with each


def load_key_check(spark, sf_dir):
    """Orders published in versions with key filters, then a batch that sends some orders again: by
    version, the keys of the batch that it holds already."""
    t = Tables(spark, sf_dir)
    root, orders = scratch_root(spark), t.orders("o_orderkey", "o_custkey", "o_totalprice")
    names = {}
    for v in range(KEY_VERSIONS):
        done = V.publish(spark, root, {"orders": orders.filter(F.col("o_orderkey") % (KEY_VERSIONS + 1) == v)},
                         keys={"orders": "o_orderkey"})
        names[done["version"]] = v
    sent = orders.filter(F.col("o_orderkey") % BATCH_MOD == 0).select("o_orderkey")
    batch = sent.unionByName(sent.select((-F.col("o_orderkey") - 1).alias("o_orderkey")))
    held = V.holders(spark, root, "orders", batch, "o_orderkey").groupBy("version").agg(F.count(F.lit(1)).alias("n"))
    known = spark.createDataFrame(list(names.items()), "version string, version_no int")
    return known.join(held, "version", "left").select(
        "version_no", F.coalesce("n", F.lit(0)).cast("bigint").alias("sent_again"))


def _accepted(spark, sf_dir) -> str:
    root, result = _loaded(spark, sf_dir, _new_orders(spark), NEW_LINE_ROWS)
    if not result["published"]:
        raise RuntimeError(f"load rejected: {result['violations']} violations")
    return root


def staged_load(spark, sf_dir):
    """The orders after the batch."""
    return V.resolve(spark, _accepted(spark, sf_dir), "orders")


def staged_load_lines(spark, sf_dir):
    """The lines after the batch."""
    return V.resolve(spark, _accepted(spark, sf_dir), "lineitem")


def staged_load_stock(spark, sf_dir):
    """The stock after the batch."""
    return V.resolve(spark, _accepted(spark, sf_dir), "stock")


def staged_load_rejected(spark, sf_dir):
    """A batch with a line of an order that doesn't exist and more pieces than there are in stock:
    rows and sums of the three tables afterwards, and the violations it was turned down for."""
    bad = [(-77, *NEW_LINE_ROWS[0][1:4], 1e9, *NEW_LINE_ROWS[0][5:])]
    root, result = _loaded(spark, sf_dir, _new_orders(spark), NEW_LINE_ROWS + bad)
    parts = [V.resolve(spark, root, name).agg(F.count(F.lit(1)).alias("row_count"), F.sum(key).alias("key_sum"))
             .select(F.lit(name).alias("tbl"), "*")
             for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("stock", "stock_qty"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.withColumn("violations", F.lit(result["violations"]).cast("bigint"))


def _incoming_rules(t: Tables):
    return [Q.Rule("price_not_null", "not_null", "price"),
            Q.Rule("price_non_negative", "check", "price", "price >= 0"),
            Q.Rule("status_domain", "domain", "status", [s for s, _ in STATUS_LABELS]),
            Q.Rule("order_id_unique", "unique", "order_id"),
            Q.Rule("customer_fk", "foreign_key", "customer_id", parent=(t.customer("c_custkey"),
                                                                          "c_custkey"))]


def validate_split(spark, sf_dir):
    t = Tables(spark, sf_dir)
    incoming = S.dirty_orders(t).select("order_id", "customer_id", "status", "price")
    return Q.split_valid(incoming, _incoming_rules(t)).select("order_id", "reject_reason")


def dq_suite(spark, sf_dir):
    t = Tables(spark, sf_dir)
    incoming = S.dirty_orders(t)
    return Q.run_suite(incoming, "orders", _incoming_rules(t))


def validate_counts(spark, sf_dir):
    """The rows that the split rejects, by rule: the same numbers as the suite's."""
    t = Tables(spark, sf_dir)
    rules = _incoming_rules(t)
    split = Q.split_valid(S.dirty_orders(t), rules)
    per = split.select(F.explode(F.split("reject_reason", ";")).alias("check_name")) \
        .groupBy("check_name").agg(F.count(F.lit(1)).alias("violations"))
    names = spark.createDataFrame([(r.name,) for r in rules], "check_name string")
    return names.join(per, "check_name", "left").select(
        "check_name", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def validate_new_keys(spark, sf_dir):
    """Incoming orders against the stored table: keys that are stored already are rejected."""
    t = Tables(spark, sf_dir)
    incoming = t.orders("o_orderkey").select((F.col("o_orderkey") * 2).alias("order_id"))
    rules = [Q.Rule("order_is_new", "new_key", "order_id", parent=(t.orders("o_orderkey"), "o_orderkey"))]
    return Q.split_valid(incoming, rules)


def integrity_suite(spark, sf_dir):
    """All four tables in one frame, over the views with planted faults."""
    t = Tables(spark, sf_dir)
    orders, lines = S.audit_orders(t), S.audit_lines(t, "l_partkey", "l_quantity", "l_discount")
    suites = [
        Q.run_suite(t.customer(), "customer", [
            Q.Rule("customer_key_unique", "unique", "c_custkey"), Q.Rule("name_not_null", "not_null", "c_name"),
            Q.Rule("balance_non_negative", "check", "c_acctbal", "c_acctbal >= 0")]),
        Q.run_suite(t.part(), "part", [
            Q.Rule("part_key_unique", "unique", "p_partkey"), Q.Rule("part_name_unique", "unique", "p_name"),
            Q.Rule("price_positive", "check", "p_retailprice", "p_retailprice > 0"),
            Q.Rule("name_length", "max_length", "p_name", 10)]),
        Q.run_suite(orders, "orders", [
            Q.Rule("order_key_unique", "unique", "o_orderkey"),
            Q.Rule("status_domain", "domain", "o_orderstatus", [s for s, _ in STATUS_LABELS]),
            Q.Rule("customer_fk", "foreign_key", "o_custkey", parent=(t.customer("c_custkey"), "c_custkey"))]),
        Q.run_suite(lines, "lineitem", [
            Q.Rule("quantity_positive", "check", "l_quantity", "l_quantity > 0"),
            Q.Rule("discount_range", "check", "l_discount", "l_discount BETWEEN 0 AND 0.08"),
            Q.Rule("order_fk", "foreign_key", "l_orderkey", parent=(orders, "o_orderkey")),
            Q.Rule("part_fk", "foreign_key", "l_partkey", parent=(t.part("p_partkey"), "p_partkey"))])]
    out = suites[0]
    for s in suites[1:]:
        out = out.unionByName(s)
    return out


def table_lifecycle(spark, sf_dir):
    """CREATE DATABASE, CREATE TABLE, INSERT ... SELECT, CREATE OR REPLACE, DROP: the rows that the
    replaced table held."""
    db = f"tally_{uuid.uuid4().hex}"
    rows = Tables(spark, sf_dir).customer("c_custkey", "c_name", "c_acctbal")
    first, second = scratch_root(spark), scratch_root(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_root(spark)}'")
    try:
        FS.create_table(spark, f"{db}.accounts", rows.schema, first)
        FS.insert_rows(rows, f"{db}.accounts")
        FS.create_table(spark, f"{db}.accounts", rows.schema, second, replace=True)
        FS.insert_rows(spark.read.schema(rows.schema).parquet(first).filter("c_acctbal > 0"), f"{db}.accounts")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    return spark.read.schema(rows.schema).parquet(second)
