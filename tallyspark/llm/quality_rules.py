"""Quality rules with cross-document line frequency.

Per document: word and symbol counts, duplicated lines, words inside repeated three-word
windows (the base rules).  Across documents: every line is normalised (ASCII lower case, blanks
folded) and hashed; for each host the distinct documents that hold the line are counted, where
copies of one text are one document.  A line above the limits of its host is boilerplate:
``with_verdict`` counts its words as removed and rejects a document that loses nearly all its
words that way (depleted), ``clean`` takes the lines out of the texts it keeps.  The base rules
always see whole texts.

Everything is built from column expressions: the per-text rules run inside the row (no
shuffle), the line table is aggregated before it is shuffled, and only the few lines above
the limits meet the documents again.

Defined results: NULL or blank text has no words and fails the base rules; a NULL host is a
host of its own; repeated rows each give a row; an empty table gives an empty result; extra
columns are ignored (``with_verdict``) or carried (``clean``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.text import (BLANK_RUN, NOT_BLANK, as_they_are, columns_free_of, let,
                                 lower_ascii, text_key, words)
from tallyspark.operators.materialize import materialize

NO_SYMBOLS = "[^#*$%&|<>]+"   # fixed value: runs without a character that counts as a symbol
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
# A line is boilerplate when more than MIN_LINE_DOCS documents of the host and more than
# MAX_LINE_PERCENT of the host's documents hold it.
MIN_LINE_DOCS = 10
MAX_LINE_PERCENT = 10
# A document is depleted when less than this percentage of its words is left.
MIN_LEFT_PERCENT = 20


def repeated_window_words(word_array: Column) -> Column:
    """Words that lie in a window of three words found at least twice in the text.

    Only where the window hashes are not all different are they sorted together with their
    positions, and the lengths of the stretches that the repeated windows cover summed."""
    hashes = F.when(
        F.size(word_array) >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(word_array) - WINDOW),
                    lambda i: F.xxhash64(*(F.get(word_array, i + k) for k in range(WINDOW))))
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(keys: Column) -> Column:
        pairs = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        starts = let(pairs, lambda p: F.transform(
            F.filter(F.transform(p, lambda x, j: F.struct(
                x["i"].alias("i"),
                ((F.get(p, j - 1)["k"] == x["k"]) | (F.get(p, j + 1)["k"] == x["k"])).alias("again"))),
                lambda x: x["again"]), lambda x: x["i"]))
        return F.aggregate(
            F.sort_array(starts), F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"),
                                    i.alias("last")), lambda acc: acc["n"])

    def of(keys: Column) -> Column:
        some_again = F.size(F.array_distinct(keys)) < F.size(keys)
        return F.when(some_again, covered(keys)).otherwise(F.lit(0))

    return let(hashes, of).cast("long")


def base_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda line: line.rlike(NOT_BLANK))
    return let(words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.regexp_replace(t, BLANK_RUN, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(t, NO_SYMBOLS, "")).cast("long").alias("n_symbols"),
        let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long")).alias("n_dup_lines"),
        repeated_window_words(w).alias("n_repeat_words")))


def line_key(line: Column) -> Column:
    """The normalised line as a 128-bit key."""
    norm = F.trim(F.regexp_replace(lower_ascii(line), BLANK_RUN, " "))
    return F.unhex(F.md5(norm))


def line_table(docs: DataFrame, text_col: str, host_col: str) -> DataFrame:
    """One row per distinct (host, text, line): host, doc, line, line_words.

    ``doc`` is the digest of the text, so that copies of a text are one document."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(host_col).alias("host"), text_key(t).alias("doc"),
                       F.explode(F.split(t, "\n", -1)).alias("raw"))
    rows = rows.filter(F.col("raw").rlike(NOT_BLANK))
    return rows.select("host", "doc", line_key(F.col("raw")).alias("line"),
                       F.size(words(F.col("raw"))).cast("long").alias("line_words"))


def depleted_texts(docs: DataFrame, text_col: str, host_col: str,
                   min_docs: int = MIN_LINE_DOCS, max_percent: int = MAX_LINE_PERCENT,
                   min_left_percent: int = MIN_LEFT_PERCENT, with_lines: bool = False) -> DataFrame:
    """(host, doc, words, words_removed, depleted) of the texts that hold boilerplate lines;
    both counts are summed over the copies of the text.  ``with_lines`` adds the keys of these
    lines (no more than the text has lines)."""
    found = [F.collect_list("line").alias("lines")] if with_lines else []
    lines = materialize(line_table(docs, text_col, host_col)
                        .groupBy("host", "doc", "line").agg(F.sum("line_words").alias("words")))
    totals = lines.groupBy("host", "doc").agg(F.sum("words").alias("words"))
    hosts = totals.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    spread = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    frequent = (spread.filter(F.col("n_docs") > min_docs)
                .join(hosts.select(F.col("host").alias("h"), "host_docs"),
                      F.col("host").eqNullSafe(F.col("h")))
                .filter(100 * F.col("n_docs") > max_percent * F.col("host_docs"))
                .select(F.col("host").alias("f_host"), F.col("line").alias("f_line")))
    # an inner join, so that AQE can split a line which a large share of the documents holds
    removed = (lines.join(frequent, (lines["line"] == frequent["f_line"])
                          & lines["host"].eqNullSafe(frequent["f_host"]))
               .groupBy("host", "doc").agg(F.sum("words").alias("words_removed"), *found)
               .withColumnsRenamed({"host": "r_host", "doc": "r_doc"}))
    left = F.col("words") - F.col("words_removed")
    return (totals.join(removed, (totals["doc"] == removed["r_doc"])
                        & totals["host"].eqNullSafe(removed["r_host"]))
            .select("host", "doc", "words", "words_removed",
                    (100 * left < min_left_percent * F.col("words")).alias("depleted"),
                    *(["lines"] if with_lines else [])))


def without_lines(text: Column, keys: Column) -> Column:
    """The text without the lines of these keys; blank lines stay."""
    left = F.filter(F.split(text, "\n", -1), lambda line: ~F.array_contains(keys, line_key(line)))
    return F.array_join(left, "\n")


def judged(docs: DataFrame, text_col: str, host_col: str, with_lines: bool, **limits
           ) -> tuple[DataFrame, str, Column]:
    """``docs`` with the verdict struct, its name, and the text without its boilerplate lines (whole
    unless ``with_lines``)."""
    n = columns_free_of(docs.columns, "verdict", "doc_key", "host_key", "counts", "hit")
    texts = depleted_texts(docs, text_col, host_col, with_lines=with_lines, **limits)
    rows = docs.withColumns({n["doc_key"]: text_key(F.col(text_col)),
                             n["host_key"]: F.col(host_col),
                             n["counts"]: base_counts(F.col(text_col))})
    hits = texts.select(F.struct(*texts.columns).alias(n["hit"]))
    joined = rows.join(hits, (F.col(n["doc_key"]) == F.col(n["hit"])["doc"])
                       & F.col(n["host_key"]).eqNullSafe(F.col(n["hit"])["host"]), "left")
    c, hit = F.col(n["counts"]), F.col(n["hit"])
    failed = ((c["n_words"] < MIN_WORDS)
              | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"]))
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    verdict = F.struct(*(c[f].alias(f) for f in fields), failed.alias("base_failed"),
                       (~failed & ~F.coalesce(hit["depleted"], F.lit(False))).alias("kept"),
                       F.coalesce((hit["words_removed"] * c["n_words"] / hit["words"]).cast("long"),
                                  F.lit(0).cast("long")).alias("words_removed"))
    text = F.col(text_col)
    if with_lines:
        text = F.when(hit["lines"].isNull(), text).otherwise(without_lines(text, hit["lines"]))
    return joined.withColumn(n["verdict"], verdict), n["verdict"], text


def with_verdict(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                 **limits) -> tuple[DataFrame, str]:
    """``docs`` with one struct column more (base counts, base_failed, words_removed, kept),
    and the free name it got."""
    rows, verdict, _ = judged(docs, text_col, host_col, False, **limits)
    return rows.select(*as_they_are(docs.columns), verdict), verdict


def clean(docs: DataFrame, text_col: str = "text", host_col: str = "source",
          **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns, the boilerplate lines taken out
    of the texts."""
    rows, verdict, text = judged(docs, text_col, host_col, True, **limits)
    return (rows.filter(F.col(verdict)["kept"]).withColumn(text_col, text)
            .select(*as_they_are(docs.columns)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    rows, verdict = with_verdict(docs)
    return rows.select("doc_id", f"{verdict}.*")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
     w AS (SELECT *, list_filter(regexp_split_to_array(t, '[ \t-\r]+'), lambda x: x <> '') AS ws FROM d),
     pos AS (SELECT rid, unnest(generate_series(1, len(ws) - 2)) AS i, ws FROM w WHERE len(ws) >= 3),
     win AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS n FROM pos),
     cov AS (SELECT rid, count(DISTINCT i + k) AS n_repeat
             FROM win, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY rid),
     ln AS (SELECT rid, source, t, unnest(string_split(t, chr(10))) AS line FROM d),
     lw AS (SELECT * FROM ln WHERE regexp_matches(line, '[^ \t-\r]')),
     dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup FROM lw GROUP BY rid),
     nl AS (SELECT source, t, rid,
                   trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+', ' ', 'g')) AS k,
                   len(regexp_extract_all(line, '[^ \t-\r]+')) AS n FROM lw),
     host AS (SELECT source, count(DISTINCT t) AS docs FROM nl GROUP BY source),
     freq AS (SELECT source, k, count(DISTINCT t) AS docs FROM nl GROUP BY source, k),
     boil AS (SELECT f.source, f.k FROM freq f JOIN host h ON f.source IS NOT DISTINCT FROM h.source
              WHERE f.docs > 10 AND 100 * f.docs > 10 * h.docs),
     lost AS (SELECT nl.rid, sum(nl.n) AS all_words,
                     sum(CASE WHEN b.k IS NOT NULL THEN nl.n ELSE 0 END) AS words_removed
              FROM nl LEFT JOIN boil b ON nl.k = b.k AND nl.source IS NOT DISTINCT FROM b.source
              GROUP BY nl.rid)
SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[ \t-\r]+', '', 'g')) AS word_chars,
       length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
       coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
       len(ws) < 50 OR 100 * coalesce(n_repeat, 0) > 50 * len(ws) AS base_failed,
       NOT (len(ws) < 50 OR 100 * coalesce(n_repeat, 0) > 50 * len(ws))
           AND NOT coalesce(words_removed > 0 AND 100 * (all_words - words_removed) < 20 * all_words, false) AS kept,
       CAST(coalesce(words_removed, 0) AS BIGINT) AS words_removed
FROM w LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN lost USING (rid)
"""
