"""Profiling: null counts, column profiles, numeric summaries, duplicate reports.

Every profile is ONE aggregate pass over the data (never a job per column); the
one-row result is unpivoted into (column, ...) rows.

Means follow the column's own type: integers and DECIMALs are summed exactly, DOUBLEs with the
built-in ``avg``.  A caller who knows that a DOUBLE column carries a fixed number of decimals
(money) may say so in ``scales`` and gets exact sums, which don't depend on the row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTEGRAL = ("tinyint", "smallint", "int", "bigint")
NUMERIC = (*INTEGRAL, "float", "double")


def is_numeric(dtype: str) -> bool:
    return dtype in NUMERIC or dtype.startswith("decimal")


def summable(x: Column, dtype: str, scale: int | None) -> Column:
    """The column in the type it is summed in: exact where its type or ``scale`` allows."""
    if dtype in INTEGRAL:
        return x.cast("decimal(20,0)")
    if dtype.startswith("decimal"):
        return x
    return x.cast("double") if scale is None else x.cast(f"decimal(18,{scale})")


def column_mean(x: Column, dtype: str, scale: int | None = None) -> Column:
    """The mean as DECIMAL where the sum is exact, else as DOUBLE."""
    return F.sum(summable(x, dtype, scale)) / F.count(x)


def _cols(df: DataFrame, cols):
    return list(cols) if cols else list(df.columns)


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """One row, one column per input column: number of NULLs (one pass)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in _cols(df, cols)])


def null_report(df: DataFrame, cols=None) -> DataFrame:
    """Rows (column_name, null_count, total_rows, missing_pct) in one pass."""
    cols = _cols(df, cols)
    wide = df.agg(F.count(F.lit(1)).alias("__total"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot("__total", cols, "column_name", "null_count")
    return long.select(
        "column_name", "null_count", F.col("__total").alias("total_rows"),
        (F.col("null_count").cast("double") * 100.0 / F.col("__total")).alias("missing_pct"))


def missing_report(df: DataFrame, cols=None) -> DataFrame:
    """Only the columns that have at least one NULL."""
    return null_report(df, cols).filter(F.col("null_count") > 0)


def clean_verify(df: DataFrame, cols=None) -> DataFrame:
    """Post-clean check: (column_name, null_count, ok) with ok = no NULL left."""
    return null_report(df, cols).select(
        "column_name", "null_count", (F.col("null_count") == 0).alias("ok"))


def profile_columns(df: DataFrame, cols=None) -> DataFrame:
    """(column_name, dtype, non_null, total_rows) -- shape, dtypes and info() in one pass."""
    cols = _cols(df, cols)
    types = dict(df.dtypes)
    wide = df.agg(F.count(F.lit(1)).alias("__total"),
                  *[F.count(F.col(c)).alias(c) for c in cols])
    long = wide.unpivot("__total", cols, "column_name", "non_null")
    dtype = F.lit(None).cast("string")
    for c in cols:
        dtype = F.when(F.col("column_name") == c, F.lit(types[c])).otherwise(dtype)
    return long.select("column_name", dtype.alias("dtype"), "non_null",
                       F.col("__total").alias("total_rows"))


def moments(x: Column, dtype: str, scale: int | None = None) -> tuple[Column, Column]:
    """(mean, sample stddev) as DOUBLE.  With ``scale`` both come from exact decimal power sums
    and single IEEE operations; DECIMAL overflow raises (ANSI)."""
    if scale is None:
        mean = F.sum(summable(x, dtype, None)).cast("double") / F.count(x)
        return mean, F.stddev_samp(x.cast("double"))
    xd = x.cast(f"decimal(18,{scale})")
    n, s1, s2 = F.count(x), F.sum(xd), F.sum(xd * xd)
    num = (n * s2 - s1 * s1).cast("double")
    return s1.cast("double") / n, F.when(n > 1, F.sqrt(num / (n * (n - 1)).cast("double")))


def describe_numeric(df: DataFrame, cols, scales: dict[str, int] | None = None) -> DataFrame:
    """Typed describe(): (column_name, count, mean, stddev, min, max) per column, one pass."""
    aggs, types = [], dict(df.dtypes)
    for c in cols:
        x = F.col(c)
        mean, std = moments(x, types[c], (scales or {}).get(c))
        aggs += [F.count(x).alias(f"{c}__count"), mean.alias(f"{c}__mean"),
                 std.alias(f"{c}__stddev"),
                 F.min(x).cast("double").alias(f"{c}__min"),
                 F.max(x).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.col(f"{c}__count").alias("count"),
                 F.col(f"{c}__mean").alias("mean"),
                 F.col(f"{c}__stddev").alias("stddev"),
                 F.col(f"{c}__min").alias("min"),
                 F.col(f"{c}__max").alias("max")) for c in cols]))
    return wide.select(stack)


def _slot(dtype: str) -> str:
    """Field name that holds values of one storage type in the long value table."""
    return "v_" + "".join(ch if ch.isalnum() else "_" for ch in dtype)


def value_counts(df: DataFrame, cols) -> DataFrame:
    """Long table ``(column_name, v_<type>..., freq)``: every distinct non-NULL value of
    every listed column with its number of rows, from ONE scan.

    Columns are stacked into rows; each value sits in the field of its own type (the other
    fields are NULL), so values keep their type and their natural order.  The grouping is
    partially aggregated map-side: a value repeated in a third of all rows collapses to
    one row per task before the shuffle."""
    types = dict(df.dtypes)
    slots = sorted({types[c] for c in cols})
    items = []
    for c in cols:
        fields = [F.lit(c).alias("column_name")]
        for t in slots:
            v = F.col(c) if types[c] == t else F.lit(None).cast(t)
            fields.append(v.alias(_slot(t)))
        items.append(F.when(F.col(c).isNotNull(), F.struct(*fields)))
    # a NULL slot inlines to an all-NULL row, dropped by the filter (no lambda function,
    # so the scan stays in whole-stage codegen)
    stacked = df.select(F.inline(F.array(*items))).filter(F.col("column_name").isNotNull())
    return stacked.groupBy("column_name", *[_slot(t) for t in slots]) \
        .agg(F.count(F.lit(1)).alias("freq"))


def _slots(vc: DataFrame) -> list[str]:
    return [c for c in vc.columns if c.startswith("v_")]


def _numeric_slots(vc: DataFrame) -> list[str]:
    return [f.name for f in vc.schema.fields
            if f.name.startswith("v_") and is_numeric(f.dataType.simpleString())]


def _num(vc: DataFrame) -> Column:
    """The numeric value of a value-count row as DOUBLE (NULL for non-numeric columns)."""
    return F.coalesce(*[F.col(c).cast("double") for c in _numeric_slots(vc)],
                      F.lit(None).cast("double"))


def modes(vc: DataFrame) -> DataFrame:
    """(column_name, count, n_unique, _best): _best is the most frequent value (ties -> smallest)
    in the slot of its type, with its ``freq``."""
    slots, w = _slots(vc), F.col("freq")
    best = F.min_by(F.struct(*slots, w.alias("freq")), F.struct((-w).alias("nf"), *slots))
    return vc.groupBy("column_name").agg(F.sum(w).alias("count"), F.count(F.lit(1)).alias("n_unique"),
                                         best.alias("_best"))


def exact_quantiles_multi(vc: DataFrame, counts: dict, qs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact linear-interpolated quantiles ``(column_name, q{pct}...)`` of the numeric
    columns in ``counts`` (column -> number of non-NULL values) from a value-count table.

    All columns share ONE ordering of ``(column_name, value)``; every distinct value is one
    row weighted by its count, so no task holds a column and a hot value costs one row.
    Only the rows covering the (at most two per quantile) wanted positions reach the final
    aggregate."""
    from tallyspark.operators.ranking import weighted_positions

    names = sorted(c for c, k in counts.items() if k)
    qname = [f"q{round(q * 100)}" for q in qs]
    if not names:
        return vc.sparkSession.range(0).select(
            F.lit(None).cast("string").alias("column_name"),
            *[F.lit(None).cast("double").alias(x) for x in qname])
    x = _num(vc)
    vals = vc.filter(F.col("column_name").isin(names)).select(
        "column_name", x.alias("v"), "freq")
    lo_pos, hi_pos, fracs, wanted, base = {}, {}, {}, set(), 0
    for c in names:
        nc = int(counts[c])
        for q in qs:
            pos = (nc - 1) * q
            lo = int(pos)
            hi = min(lo + 1, nc - 1) if pos > lo else lo
            lo_pos[(c, q)], hi_pos[(c, q)], fracs[(c, q)] = base + lo + 1, base + hi + 1, pos - lo
            wanted.update({base + lo + 1, base + hi + 1})
        base += nc
    picked = weighted_positions(vals, ["column_name", "v"], "freq", sorted(wanted))

    def at(table, q):
        m = F.create_map(*[z for c in names for z in (F.lit(c), F.lit(table[(c, q)]))])
        p = F.element_at(m, F.col("column_name"))
        return F.max(F.when((F.col("_start") <= p) & (F.col("_end") >= p), F.col("v")))

    aggs = []
    for q, name in zip(qs, qname):
        fm = F.create_map(*[z for c in names for z in (F.lit(c), F.lit(float(fracs[(c, q)])))])
        v_lo, v_hi = at(lo_pos, q), at(hi_pos, q)
        aggs.append((v_lo + (v_hi - v_lo) * F.first(F.element_at(fm, F.col("column_name"))))
                    .alias(name))
    return picked.groupBy("column_name").agg(*aggs)


BRACKET = 10_000         # accuracy of the approximate quantiles that bracket an exact one
BRACKET_SLACK = 2.0      # how many times their error the bracket reaches to either side


def bracketed_quantiles(df: DataFrame, cols, qs=(0.5,), own_type: bool = True) -> dict[tuple[str, float], Column]:
    """The exact interpolated quantiles of the columns as literals in the column's own type (integers: DOUBLE;
    DECIMAL stays DECIMAL, half-up) or, without ``own_type``, as DOUBLE; NULL where a column has no value.

    Approximate quantiles bracket each wanted position (one aggregate for all columns); a second pass
    counts the rows below the brackets and the values inside them, a few rows in BRACKET, and
    only those are ordered.  A bracket that misses its positions is widened."""
    from tallyspark.operators.materialize import materialize_observed
    from tallyspark.operators.ranking import weighted_positions

    types, out, slack = dict(df.dtypes), {}, BRACKET_SLACK / BRACKET
    slots = sorted({types[c] for c in cols})
    todo = [(c, q) for c in cols for q in qs]
    while todo:
        ends = df.agg(*[F.count(c).alias(f"n{i}") for i, (c, _) in enumerate(todo)],
                      *[F.percentile_approx(c, [max(0.0, q - slack), min(1.0, q + slack)], BRACKET).alias(f"b{i}")
                        for i, (c, q) in enumerate(todo)]).first()
        items, brackets = [], []
        for i, (c, q) in enumerate(todo):
            if not ends[f"n{i}"]:
                out[c, q] = F.lit(None).cast("double" if types[c] in INTEGRAL else types[c])
                continue
            brackets.append(i)
            low, high = (F.lit(x).cast(types[c]) for x in ends[f"b{i}"])
            # all rows below the bracket are one value, NULL; at either end it is open
            under = F.col(c) < low if q > slack else F.lit(False)
            values = [(F.when(~under, F.col(c)) if types[c] == t else F.lit(None).cast(t)).alias(_slot(t)) for t in slots]
            items.append(F.when(F.col(c) <= high if q + slack < 1 else F.col(c).isNotNull(), F.struct(F.lit(i).alias("k"), under.alias("under"), *values)))
        if not items:
            break
        names = [_slot(t) for t in slots]
        inside, held = materialize_observed(
            df.select(F.inline(F.array(*items))).filter("k IS NOT NULL").groupBy("k", "under", *names)
            .agg(F.count(F.lit(1)).alias("freq")),
            *[F.sum(F.when((F.col("k") == i) & (F.col("under") == u), F.col("freq"))).alias(f"{'u' if u else 'n'}{i}")
              for i in brackets for u in (True, False)])
        inside = inside.filter(~F.col("under")).drop("under")
        wanted, missed, base = {}, [], 0
        for i in brackets:
            c, q = todo[i]
            first, inner, at = held[f"u{i}"] or 0, held[f"n{i}"] or 0, (ends[f"n{i}"] - 1) * q
            lo, hi = int(at), int(at) + (at > int(at))
            if first <= lo and hi < first + inner:
                wanted[i] = (base + lo - first + 1, base + hi - first + 1, at - lo)
            else:
                missed.append((c, q))
            base += inner
        spans = weighted_positions(inside, ["k", *names], "freq", [p for w in wanted.values() for p in w[:2]]).collect() \
            if wanted else []       # at most two rows a quantile
        for i, (lo, hi, share) in wanted.items():
            kind = types[todo[i][0]]
            a, b = (F.lit(next(r[_slot(kind)] for r in spans if r["_start"] <= p <= r["_end"])) for p in (lo, hi))
            out[todo[i]] = _between(a, b, share, kind, own_type)
        todo, slack = missed, slack * 8
    return out


def _between(a: Column, b: Column, share: float, kind: str, own_type: bool) -> Column:
    """The point that divides a and b by ``share``."""
    if kind.startswith("decimal"):
        a, b = a.cast(kind), b.cast(kind)
        return (a + (b - a) * F.lit(repr(round(share, 6))).cast("decimal(7,6)")).cast(kind if own_type else "double")
    return (a.cast("double") + (b.cast("double") - a.cast("double")) * F.lit(float(share))).cast(
        "double" if kind in INTEGRAL else kind)


def counted_value_counts(df: DataFrame, cols) -> tuple[DataFrame, dict]:
    """``value_counts`` written once to the shared scratch folder (several jobs read it), with
    every column's non-NULL count observed during that write.  Returns (table, counts)."""
    from tallyspark.operators.materialize import materialize_observed

    metrics = [F.coalesce(F.sum(F.when(F.col("column_name") == c, F.col("freq"))), F.lit(0)).alias(f"n{i}")
               for i, c in enumerate(cols)]
    vc, got = materialize_observed(value_counts(df, cols), *metrics)
    return vc, {c: int(got[f"n{i}"]) for i, c in enumerate(cols)}


def exact_quantiles(df: DataFrame, c: str, qs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact linear-interpolated quantiles of column ``c`` as one row ``q{pct}`` columns
    (NULL when the column has no value)."""
    vc, counts = counted_value_counts(df.select(F.col(c).cast("double").alias(c)), [c])
    got = exact_quantiles_multi(vc, counts, qs)
    one = df.sparkSession.range(1).select(F.lit(c).alias("column_name"))
    return one.join(got, "column_name", "left").drop("column_name")


def top_values(df: DataFrame, cols) -> DataFrame:
    """Most frequent non-NULL value per column (ties -> smallest value) as one row with a
    typed field per column: ``{c}`` holds the value, ``{c}__freq`` its count.  One stacked
    value count for all columns, one min_by per column."""
    types = dict(df.dtypes)
    st = modes(value_counts(df, cols))
    aggs = []
    for c in cols:
        hit = F.col("column_name") == c
        aggs.append(F.max(F.when(hit, F.col(f"_best.{_slot(types[c])}"))).alias(c))
        aggs.append(F.max(F.when(hit, F.col("_best.freq"))).alias(f"{c}__freq"))
    return st.agg(*aggs)


def top_value(df: DataFrame, c: str) -> DataFrame:
    """Most frequent non-null value and its count (ties -> smallest value); one row, or
    none when the column has no value."""
    t = top_values(df, [c])
    return t.select(F.col(c).alias("top"), F.col(f"{c}__freq").alias("freq")) \
        .filter(F.col("top").isNotNull())


STAT_COLS = ("mean", "std", "min", "p25", "p50", "p75", "max")


def describe_all(df: DataFrame, cols, scales: dict[str, int] | None = None) -> DataFrame:
    """describe(include='all'): one row per column with count, n_unique, top, freq, mean,
    std, min, quartiles, max.  Numeric statistics are NULL for string columns and
    top/freq NULL for numeric ones.

    Three things side by side, none of which orders a column: distinct values and modes from one
    stacked value count, moments and extremes from one aggregate, quartiles from brackets
    (``bracketed_quantiles``).  Each is a row a column, joined by column name."""
    types = dict(df.dtypes)
    numeric = [c for c in cols if is_numeric(types[c])]
    counts = modes(value_counts(df, cols))
    top = F.coalesce(*[F.col(f"_best.{_slot(t)}").cast("string") for t in sorted({types[c] for c in cols})])
    is_num = F.col("column_name").isin(numeric) if numeric else F.lit(False)
    # the described columns as a literal list, so an all-NULL column still gets its row
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    out = names.join(counts.select("column_name", "count", "n_unique", top.alias("top"),
                                   F.col("_best.freq").alias("freq")), "column_name", "left")
    if numeric:
        quartiles = bracketed_quantiles(df, numeric, (0.25, 0.5, 0.75), own_type=False)
        stats = describe_numeric(df, numeric, scales).select("column_name", "mean", F.col("stddev").alias("std"), "min", "max")
        out = out.join(stats, "column_name", "left")
        for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            value = F.lit(None).cast("double")
            for c in numeric:
                value = F.when(F.col("column_name") == c, quartiles[c, q].cast("double")).otherwise(value)
            out = out.withColumn(name, value)
    else:
        out = out.withColumns({s: F.lit(None).cast("double") for s in STAT_COLS})
    return out.select(
        "column_name", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        F.coalesce(F.col("n_unique"), F.lit(0)).cast("bigint").alias("n_unique"),
        F.when(~is_num, F.col("top")).alias("top"),
        F.when(~is_num, F.col("freq")).cast("bigint").alias("freq"),
        *[F.col(s).cast("double").alias(s) for s in STAT_COLS])


def dup_report(df: DataFrame, cols=None) -> DataFrame:
    """(total_rows, distinct_rows, duplicate_rows) over the chosen columns.
    Partial aggregation by row value first, so a heavily repeated row collapses map-side."""
    cols = _cols(df, cols)
    per_row = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    return per_row.agg(F.sum("__n").alias("total_rows"),
                       F.count(F.lit(1)).alias("distinct_rows"),
                       (F.sum("__n") - F.count(F.lit(1))).alias("duplicate_rows"))
