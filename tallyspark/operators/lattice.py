"""Column types with evidence: which types a text column's values fit, and what speaks against them.

One aggregate over all columns counts, for every candidate type, the values that fit it, and keeps the
smallest one that doesn't.  Counts add up and digits take their maximum, so the evidence of
batches merges, and a type only ever widens:

    boolean   int < bigint < decimal(p,s) < double   date (one of some formats)   < string
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How numbers and booleans are written.
WHOLE = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?[0-9]+([.][0-9]+)?$"
DOUBLE = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
BOOLEAN = r"^(true|false)$"
# Date formats with the shape that a value has to have.
DATES = {"yyyy-MM-dd": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "dd/MM/yyyy": r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$",
         "yyyyMMdd": r"^[0-9]{8}$"}
MOST_DIGITS = 38
SIMPLE = ("boolean", "int", "bigint", "decimal", "double")


def candidates() -> list[str]:
    return [*SIMPLE, *[f"date({f})" for f in DATES]]


def _fits(c: Column) -> dict[str, Column]:
    whole, number = c.rlike(WHOLE), c.rlike(DECIMAL)
    digits = F.length(F.regexp_replace(c, "[^0-9]", ""))
    out = {"boolean": F.lower(c).rlike(BOOLEAN), "int": whole & c.try_cast("int").isNotNull(),
           "bigint": whole & c.try_cast("bigint").isNotNull(), "decimal": number & (digits <= MOST_DIGITS),
           "double": c.rlike(DOUBLE)}
    for f, shape in DATES.items():
        out[f"date({f})"] = c.rlike(shape) & F.try_to_date(c, f).isNotNull()
    return out


def evidence(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, candidate, n_values, n_fit, example, before, after): ``example`` is the smallest value that
    doesn't fit, ``before`` and ``after`` the most digits on either side of the point.  NULL and empty
    text say nothing."""
    columns, aggs, items = columns or df.columns, [], []
    for i, name in enumerate(columns):
        c = F.when(F.col(name) != "", F.col(name))
        number = F.regexp_replace(F.when(c.rlike(DECIMAL), c), "[+-]", "")
        aggs += [F.count(c).alias(f"n{i}"), F.max(F.length(F.substring_index(number, ".", 1))).alias(f"b{i}"),
                 F.max(F.when(number.contains("."), F.length(F.substring_index(number, ".", -1))).otherwise(0)).alias(f"a{i}")]
        for j, (kind, fit) in enumerate(_fits(c).items()):
            aggs += [F.count_if(fit).alias(f"f{i}_{j}"), F.min(F.when(~fit, c)).alias(f"e{i}_{j}")]
            items.append(F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("candidate"),
                                  F.col(f"n{i}").alias("n_values"), F.col(f"f{i}_{j}").alias("n_fit"),
                                  F.col(f"e{i}_{j}").alias("example"), F.col(f"b{i}").cast("int").alias("before"),
                                  F.col(f"a{i}").cast("int").alias("after")))
    return df.agg(*aggs).select(F.inline(F.array(*items)))


def merged(*parts: DataFrame) -> DataFrame:
    """The evidence of several batches together."""
    both = reduce(DataFrame.unionByName, parts)
    return both.groupBy("column_name", "candidate").agg(
        F.sum("n_values").alias("n_values"), F.sum("n_fit").alias("n_fit"), F.min("example").alias("example"),
        F.max("before").alias("before"), F.max("after").alias("after"))


def _rank(kind: Column) -> Column:
    out = F.lit(None)
    for i, name in reversed(list(enumerate(candidates()))):
        out = F.when(kind == name, i).otherwise(out)
    return out


def chosen(found: DataFrame) -> DataFrame:
    """(column_name, type, n_values): the narrowest type that every value fits, else string; whole numbers beyond
    BIGINT and fractions take DECIMAL by their digits while these are at most MOST_DIGITS."""
    fits = (F.col("n_fit") == F.col("n_values")) & (F.col("n_values") > 0)
    digits = F.col("before") + F.col("after")
    ok = fits & ((F.col("candidate") != "decimal") | (digits <= MOST_DIGITS))
    best = found.groupBy("column_name").agg(
        F.min(F.when(ok, F.struct(_rank(F.col("candidate")).alias("rank"), "candidate", digits.alias("p"), "after"))).alias("best"),
        F.max("n_values").alias("n_values"))
    kind = F.when(F.col("best.candidate") == "decimal",
                  F.concat(F.lit("decimal("), F.col("best.p"), F.lit(","), F.col("best.after"), F.lit(")"))) \
        .otherwise(F.coalesce("best.candidate", F.lit("string")))
    return best.select("column_name", kind.alias("type"), "n_values")


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``df`` with its text columns in the given types (as ``chosen`` names them); empty text is NULL."""
    out = {}
    for name, kind in types.items():
        c = F.when(F.col(name) != "", F.col(name))
        out[name] = F.to_date(c, kind[5:-1]) if kind.startswith("date(") else c.cast(kind)
    return df.withColumns(out)
