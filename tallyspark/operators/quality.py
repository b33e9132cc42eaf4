"""Declarative data-quality rules.

UNIQUE has one meaning everywhere: NULL keys are ignored, and every row of a key that occurs more
than once is a violation (none of the copies is kept).  ``new_key`` rejects keys that a stored
table already has.

A rule is data: ``Rule(name, kind, column, arg)``.  Row-level rules (not_null, range,
domain, max_length) are evaluated together in ONE aggregate pass; uniqueness and
foreign-key rules each need one shuffle (an aggregate by key, an anti join).
A CHECK-style predicate passes on NULL (SQL semantics): only ``pred IS FALSE`` counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.materialize import materialize


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str              # not_null | check | domain | max_length | unique | foreign_key | new_key
    column: str | tuple
    arg: object = None     # check: SQL predicate text; domain: values; max_length: int;
    parent: object = field(default=None, compare=False)  # foreign_key, new_key: (DataFrame, column)


def row_violation(rule: Rule) -> Column:
    """TRUE where the row breaks a row-level rule."""
    c = F.col(rule.column) if isinstance(rule.column, str) else None
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "check":
        return F.coalesce(~F.expr(rule.arg), F.lit(False))
    if rule.kind == "domain":
        return F.coalesce(~c.isin(list(rule.arg)), F.lit(False))
    if rule.kind == "max_length":
        return F.coalesce(F.length(c) > int(rule.arg), F.lit(False))
    raise ValueError(rule.kind)


ROW_KINDS = ("not_null", "check", "domain", "max_length")


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Key values (none of them NULL) that occur more than once, with their count."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose (non-NULL) reference has no parent row (LEFT ANTI join).

    The anti join reads the *distinct* parent keys: partial aggregation collapses a key
    repeated in a third of the parent rows before the shuffle (AQE cannot split the build
    side of an anti join), and the aggregate's hash partitioning is reused by the join."""
    p = parent.select(F.col(parent_col).alias("__pk")).distinct()
    return child.filter(F.col(child_col).isNotNull()) \
        .join(p, F.col(child_col) == p["__pk"], "left_anti")


def run_suite(df: DataFrame, table: str, rules) -> DataFrame:
    """(check_name, table_name, violations, status) for every rule; row-level rules share a
    single aggregate pass."""
    row_rules = [r for r in rules if r.kind in ROW_KINDS]
    parts = []
    if row_rules:
        wide = df.agg(*[F.count_if(row_violation(r)).alias(f"r{i}") for i, r in enumerate(row_rules)])
        stacked = wide.select(F.inline(F.array(*[
            F.struct(F.lit(r.name).alias("check_name"), F.col(f"r{i}").alias("violations"))
            for i, r in enumerate(row_rules)])))
        parts.append(stacked)
    for r in rules:
        if r.kind == "unique":
            v = duplicate_keys(df, r.column).agg(F.coalesce(F.sum("cnt"), F.lit(0))
                                                 .cast("bigint").alias("violations"))
        elif r.kind == "foreign_key":
            parent_df, parent_col = r.parent
            v = orphans(df, r.column, parent_df, parent_col).agg(F.count(F.lit(1)).alias("violations"))
        elif r.kind == "new_key":
            stored = r.parent[0].select(F.col(r.parent[1]).alias("__pk")).distinct()
            v = df.join(stored, df[r.column] == stored["__pk"], "left_semi") \
                .agg(F.count(F.lit(1)).alias("violations"))
        else:
            continue
        parts.append(v.select(F.lit(r.name).alias("check_name"), "violations"))
    out = df.sparkSession.createDataFrame([], "check_name string, violations bigint")
    for p in parts:
        out = out.unionByName(p)
    return out.select("check_name", F.lit(table).alias("table_name"), "violations",
                      F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status"))


def _breaking(rows: DataFrame, rule: Rule) -> DataFrame:
    """The ``__row`` of the rows that break a rule on keys; only the rule's columns move."""
    keys = [rule.column] if isinstance(rule.column, str) else list(rule.column)
    narrow = rows.select("__row", *keys)
    if rule.kind == "unique":
        return narrow.join(duplicate_keys(narrow, keys).select(*keys), keys, "left_semi").select("__row")
    if rule.kind == "new_key":
        stored = rule.parent[0].select(F.col(rule.parent[1]).alias("__key")).distinct()
        return narrow.join(stored, F.col(rule.column) == F.col("__key"), "left_semi").select("__row")
    if rule.kind == "foreign_key":
        return orphans(narrow, rule.column, *rule.parent).select("__row")
    raise ValueError(rule.kind)


def split_valid(df: DataFrame, rules) -> DataFrame:
    """Tag every row with the names of the rules it breaks (``reject_reason``, NULL when the row is
    accepted).  Row-level rules are expressions.  Rules on keys join their key columns alone, each
    giving the numbers of the rows that break it; those are put together and joined to the whole
    rows once, however many rules there are."""
    own = [F.when(row_violation(r), F.struct(F.lit(i).alias("i"), F.lit(r.name).alias("name")))
           for i, r in enumerate(rules) if r.kind in ROW_KINDS]
    found = F.array_compact(F.array(*own)) if own else F.lit(None).cast("array<struct<i:int,name:string>>")
    keyed = [(i, r) for i, r in enumerate(rules) if r.kind not in ROW_KINDS]
    rows = df
    if keyed:
        # written with its row numbers, which every rule reads
        rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()))
        broken = reduce(DataFrame.unionByName, [
            _breaking(rows, r).select("__row", F.struct(F.lit(i).alias("i"), F.lit(r.name).alias("name")).alias("__why"))
            for i, r in keyed])
        per_row = broken.groupBy("__row").agg(F.collect_set("__why").alias("__why"))    # at most a rule each
        rows = rows.join(per_row, "__row", "left")
        found = F.concat(F.coalesce(found, F.array().cast("array<struct<i:int,name:string>>")),
                         F.coalesce("__why", F.array().cast("array<struct<i:int,name:string>>")))
    names = F.transform(F.array_sort(found), lambda x: x["name"])
    reason = F.when(F.size(found) > 0, F.array_join(names, ";"))
    return rows.withColumn("reject_reason", reason).select(*[f"`{c}`" for c in df.columns], "reject_reason")


def reconcile(headers: DataFrame, lines: DataFrame, key: str, header_total: str,
              line_amount, tolerance: float = 0.01, line_key: str | None = None,
              total_type: str = "decimal(18,2)") -> DataFrame:
    """Header total vs the sum of its lines (rounded half-up to cents): every header whose
    gap exceeds ``tolerance``.  ``total_type`` is the DECIMAL that the header totals carry.  Lines are aggregated per key before the join, so the join
    runs at header grain; amounts are exact decimals."""
    lk = line_key or key
    per = lines.groupBy(F.col(lk).alias("__k")).agg(F.round(F.sum(line_amount), 2).alias("computed"))
    j = headers.join(per, headers[key] == per["__k"])
    gap = F.abs(F.col(header_total).cast(total_type) - F.col("computed"))
    return j.filter(gap > tolerance).select(
        F.col(key).alias("order_id"), F.col(header_total).cast("double").alias("header_total"),
        F.col("computed").cast("double").alias("computed_total"))
