"""Order-cleaning queries: coercion, median/mode imputation, derived amounts, the full
cleaning pipeline, dense row ids and column profiles over the dirty order view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.money import money
from tallyspark.operators import clean as C
from tallyspark.operators import profile as P
from tallyspark.operators.materialize import materialize
from tallyspark.session import scratch_root
from tallyspark.sources import files as FS
from tallyspark.sources import standins as S
from tallyspark.sources.tables import Tables


def _dirty(spark, sf_dir) -> DataFrame:
    return S.dirty_orders(Tables(spark, sf_dir))


def coerce_numeric(spark, sf_dir):
    d = _dirty(spark, sf_dir).select("order_id", "price_text")
    return C.coerce_numeric(d, ["price_text"]).withColumnRenamed("price_text", "price_num")


def impute_median(spark, sf_dir):
    d = _dirty(spark, sf_dir).select("order_id", "price", "quantity")
    return C.impute_median(d, ["price", "quantity"])


def impute_mode(spark, sf_dir):
    d = _dirty(spark, sf_dir).select("order_id", "status", "category")
    return C.impute_mode(d, ["status", "category"])


def derive_amount(spark, sf_dir):
    d = _dirty(spark, sf_dir).select("order_id", "price", "quantity")
    return d.withColumn("total_amount", F.round(money("price") * F.col("quantity"), 2).cast("double"))


RAW_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("price", T.StringType()),
    T.StructField("quantity", T.IntegerType()), T.StructField("order_date", T.DateType()),
    T.StructField("category", T.StringType())])
MIN_PRICE = 1000.0


def _raw_file(spark, sf_dir) -> str:
    """The order view as a CSV file: the price is text (blank or junk)."""
    d = _dirty(spark, sf_dir)
    raw = d.withColumn("price", F.when(F.col("price").isNotNull(), F.col("price_text"))).select(RAW_SCHEMA.names)
    path = scratch_root(spark)
    FS.write_csv(raw, path)
    return path


def clean_orders(spark, sf_dir) -> DataFrame:
    """load CSV -> coerce -> median fill (price, quantity) -> mode fill (status, category) -> drop
    exact duplicates -> price and category filters -> total_amount -> save -> read back."""
    raw = FS.read_csv(spark, _raw_file(spark, sf_dir), schema=RAW_SCHEMA)
    # parsed once: the fill values and the result are read from the typed rows
    typed = materialize(C.coerce_numeric(raw, ["price"]))
    filled = C.impute_mode(C.impute_median(typed, ["price", "quantity"]), ["status", "category"])
    kept = C.dedup_exact(filled).filter((F.col("price") > MIN_PRICE) & (F.col("category") != "5-LOW"))
    amount = F.round(F.col("price").cast("decimal(18,4)") * F.col("quantity").cast("decimal(10,1)"), 2)
    out = kept.withColumn("total_amount", amount.cast("decimal(18,2)"))
    path = scratch_root(spark)
    FS.write_csv(out, path)
    return FS.read_csv(spark, path, schema=out.schema, mode="FAILFAST")


def clean_orders_detail(spark, sf_dir):
    """The saved orders."""
    return clean_orders(spark, sf_dir).withColumn("total_amount", F.col("total_amount").cast("double"))


def clean_orders_pipeline(spark, sf_dir):
    """Revenue by category of the saved orders."""
    return (clean_orders(spark, sf_dir).groupBy("category")
            .agg(F.sum("total_amount").cast("double").alias("total_revenue"),
                 F.round(F.sum("total_amount") / F.count(F.lit(1)), 2).cast("double")
                 .alias("avg_order_value"),
                 F.count(F.lit(1)).alias("order_count"))
            .orderBy(F.desc("total_revenue")))


def dense_row_id(spark, sf_dir):
    d = C.dedup_exact(_dirty(spark, sf_dir))
    return C.dense_row_id(d, ["order_id"]).select("order_id", "row_id")


def profile_columns(spark, sf_dir):
    return P.profile_columns(_dirty(spark, sf_dir))


FRACTIONS = ("mean", "std", "stddev", "p25", "p50", "p75")


def _rounded(df: DataFrame) -> DataFrame:
    """Moments and interpolated quartiles to six decimals: their last bits hang on the order of
    DOUBLE operations."""
    return df.withColumns({c: F.round(c, 6) for c in FRACTIONS if c in df.columns})


def describe_all(spark, sf_dir):
    return _rounded(P.describe_all(_dirty(spark, sf_dir), ["price", "quantity", "status", "category"],
                                   scales={"price": 2}))


def _measures(spark, sf_dir) -> DataFrame:
    return S.measures(Tables(spark, sf_dir))


def describe_all_measures(spark, sf_dir):
    """DOUBLE with many decimals, DECIMAL(10,2) and DECIMAL(12,4) columns."""
    return _rounded(P.describe_all(_measures(spark, sf_dir), ["ratio", "amount", "unit"]))


def describe_numeric_measures(spark, sf_dir):
    return _rounded(P.describe_numeric(_measures(spark, sf_dir), ["ratio", "amount", "unit"]))


def impute_mean_measures(spark, sf_dir):
    return C.impute_mean(_measures(spark, sf_dir), ["ratio", "unit"], decimals=4) \
        .withColumn("unit", F.col("unit").cast("double")).withColumn("amount", F.col("amount").cast("double"))


def impute_by_dtype_measures(spark, sf_dir):
    filled = C.impute_by_dtype(_measures(spark, sf_dir), exclude=("order_id",))
    return filled.withColumns({c: F.col(c).cast("double") for c in ("amount", "unit")})
