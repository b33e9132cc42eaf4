"""Global ROW_NUMBER / RANK / DENSE_RANK / NTILE without a single-partition sort.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.  Here the rows
are laid out as Spark's own ``orderBy`` lays them out: one range exchange on the *complete* sort
key (value columns plus a tie-break, so a value that repeats in a third of all rows spreads over
many ranges), sorted inside each range, and written once together with the range (``_bk``) and
the position in it (``_pos``).  That is the only shuffle of the rows:

* ROW_NUMBER is the position plus the rows of earlier ranges (one count per range, a small frame
  that is joined); NTILE follows from it and the row count.
* RANK over the first keys is the smallest row number of each distinct value of them; DENSE_RANK
  is the position of that value in the same ordering of the distinct values alone.  Both come
  from an aggregate over the written rows (partial aggregation collapses a hot value) and are
  joined back null-safe, in a join of two plain exchanges that AQE can split.

The same steps run at every size.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.materialize import materialize, materialize_observed

# monotonically_increasing_id: the partition above these bits, the row's number in it below
ROW_BITS = 33


@dataclass(frozen=True)
class Key:
    name: str
    desc: bool = False

    def sort_col(self) -> Column:
        c = F.col(self.name)
        return c.desc_nulls_last() if self.desc else c.asc_nulls_last()


def _keys(spec) -> list[Key]:
    out = []
    for k in spec:
        if isinstance(k, Key):
            out.append(k)
        elif isinstance(k, tuple):
            out.append(Key(k[0], bool(k[1])))
        else:
            out.append(Key(k))
    return out


@dataclass(frozen=True)
class Ordered:
    """Rows written in sort order: the frame's columns plus ``_bk`` and ``_pos``."""
    rows: DataFrame
    keys: list[Key]
    n: int
    metrics: dict


def ordered_plan(df: DataFrame, keys) -> DataFrame:
    """The plan that ``ordered`` writes."""
    cols = [k.sort_col() for k in _keys(keys)]
    placed = (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
              .withColumn("_id", F.monotonically_increasing_id()))
    return placed.withColumns({"_bk": F.shiftright("_id", ROW_BITS).cast("int"),
                               "_pos": F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))}).drop("_id")


def ordered(df: DataFrame, keys, *metrics: Column) -> Ordered:
    """Write ``df`` in the order ``keys`` (make it total with a unique last key).  ``metrics`` are
    named aggregates observed during the write."""
    rows, seen = materialize_observed(ordered_plan(df, keys), *metrics)
    return Ordered(rows, _keys(keys), int(seen["n"]), seen)


def _before(rows: DataFrame, weight: Column, name: str) -> tuple[DataFrame, list[tuple]]:
    """(``_bk``, weight of all earlier ranges) as a small frame and as a list with the range's own
    weight: one row for each range, which the session's shuffle partitions bound."""
    own = sorted((r["_bk"], int(r["w"] or 0)) for r in rows.groupBy("_bk").agg(weight.alias("w")).collect())
    out, total = [], 0
    for b, w in own:
        out.append((b, total, w))
        total += w
    return rows.sparkSession.createDataFrame([x[:2] for x in out], f"_bk int, {name} bigint"), out


def row_numbers(o: Ordered, name: str) -> DataFrame:
    offsets, _ = _before(o.rows, F.count(F.lit(1)), "_offset")
    return (o.rows.join(F.broadcast(offsets), "_bk")
            .withColumn(name, F.col("_offset") + F.col("_pos") + 1).drop("_bk", "_pos", "_offset"))


def _attach(rows: DataFrame, groups: DataFrame, names: list[str]) -> DataFrame:
    """Join per-value columns back on the (possibly NULL) values ``names``."""
    g = groups.withColumnsRenamed({c: f"_g_{c}" for c in names})
    match = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(g[f"_g_{c}"]) for c in names])
    return rows.join(g, match).drop(*[f"_g_{c}" for c in names])


def with_ranks(o: Ordered, rank_prefixes=(), ntiles=(), prefix: str = "_g",
               dense: bool = True) -> DataFrame:
    """Add ``{prefix}_rn`` (1-based position), for each ``L`` in ``rank_prefixes`` the RANK over the
    first ``L`` keys (``{prefix}_rank{L}``) and, with ``dense``, DENSE_RANK (``{prefix}_dense{L}``),
    and ``{prefix}_ntile{t}`` for each t."""
    rn = f"{prefix}_rn"
    out = row_numbers(o, rn)
    for length in sorted(set(int(x) for x in rank_prefixes)):
        keys = o.keys[:length]
        names = [k.name for k in keys]
        groups = out.groupBy(*names).agg(F.min(rn).alias(f"{prefix}_rank{length}"))
        if dense:
            groups = row_numbers(ordered(groups, keys), f"{prefix}_dense{length}")
        else:
            groups = materialize(groups)
        out = _attach(out, groups, names)
    for t in ntiles:
        out = out.withColumn(f"{prefix}_ntile{t}", ntile_from_rn(F.col(rn), o.n, t))
    return out


def global_order(df: DataFrame, keys, rank_prefixes=(), ntiles=(), prefix: str = "_g",
                 dense: bool = True) -> DataFrame:
    """``with_ranks`` of ``df`` written in the order ``keys``."""
    return with_ranks(ordered(df, keys), rank_prefixes, ntiles, prefix, dense)


def weighted_positions(df: DataFrame, keys, weight: str, positions, start: str = "_start",
                       end: str = "_end") -> DataFrame:
    """Rows of ``df`` in the order ``keys`` where each row stands for ``weight`` consecutive
    positions (e.g. a distinct value and its count): the rows whose span ``[start, end]``
    (1-based, inclusive) covers one of the wanted ``positions``.

    ``keys`` should be unique per row.  Ranges are balanced on rows of ``df``, so a value that
    repeats in a third of the underlying data is one row here.  Only ranges that hold a wanted
    position are read again, with a running sum of the weights inside each."""
    o = ordered(df, keys)
    offsets, spans = _before(o.rows, F.sum(weight), "_offset")
    wanted = sorted({int(p) for p in positions})
    need = [b for b, before, w in spans if any(before < p <= before + w for p in wanted)]
    running = (Window.partitionBy("_bk").orderBy("_pos")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (o.rows.filter(F.col("_bk").isin(need) if need else F.lit(False))
           .join(F.broadcast(offsets), "_bk")
           .withColumn(end, F.col("_offset") + F.sum(weight).over(running))
           .withColumn(start, F.col(end) - F.col(weight) + 1))
    cover = F.lit(False)
    for p in wanted:
        cover = cover | ((F.col(start) <= p) & (F.col(end) >= p))
    return out.filter(cover).drop("_bk", "_pos", "_offset")


def ntile_from_rn(rn: Column, n: int, t: int) -> Column:
    """NTILE(t) from a 1-based global row number and the row count (SQL semantics:
    the first ``n mod t`` tiles get one extra row)."""
    q, r = divmod(n, t)
    if q == 0:
        return rn.cast("bigint")
    big = r * (q + 1)
    return F.when(rn <= big, F.ceil(rn / F.lit(q + 1))) \
        .otherwise(F.lit(r) + F.ceil((rn - F.lit(big)) / F.lit(q))).cast("bigint")


def partitioned_row_number(df: DataFrame, partition_cols, order_keys, prefix: str = "_p") -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY p ORDER BY o) with any share of the rows in one partition:
    the global order on (p, o), less the first row number of the partition."""
    names = list(partition_cols)
    rows = row_numbers(ordered(df, [Key(c) for c in names] + _keys(order_keys)), "_rn")
    firsts = materialize(rows.groupBy(*names).agg(F.min("_rn").alias("_first")))
    return (_attach(rows, firsts, names)
            .withColumn(f"{prefix}_rn", F.col("_rn") - F.col("_first") + 1).drop("_rn", "_first"))
