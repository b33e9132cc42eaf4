"""Exact dedup by a tree-merge of digest runs.

Every document becomes ``(id, digest of its normalised text)``.  Documents are dealt into
``RUNS`` runs by a hash of id and digest; within a run equal digests collapse to one entry (best
id, count).  The runs are cut at the same digests, so that a partition holds the same digest range
of every run, and then merged in binomial rounds: in each, every run meets its neighbour, run
numbers are halved, and each digest keeps its best identifier and summed count, until after log2
RUNS rounds a single (distributed) run is left.  The cut is the one exchange of the rounds: their
aggregates find the entries of a digest in one partition already.  A group that holds a third of
all rows has at most one entry for each run there, so no merge task sees it whole.
The verdicts travel back down: root -> runs -> documents, joined on ``(run, digest)``, so a hot
digest is spread over ``RUNS`` keys.

An entry is *verified*: SHA-256, byte length and an independent 64-bit hash must all agree
for two entries to merge.

Defined results: NULL text counts as empty; a NULL id never wins against another id; rows
repeated with the same id and text count each, and one of them stays.  An empty table gives
an empty result.  Extra columns are ignored (``decisions``) or carried (``keep_one``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.text import as_they_are, columns_free_of, lower_ascii
from tallyspark.operators.materialize import materialize_observed

RUNS = 1024              # a power of two
ENTRY = ["digest", "nbytes", "proof"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (id, normalised text): run, id, digest, nbytes, proof, copies."""
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    d = docs.select(F.col(id_col).alias("id"), norm.alias("norm"))
    d = d.select("id", F.unhex(F.sha2("norm", 256)).alias("digest"),
                 F.octet_length("norm").alias("nbytes"), F.xxhash64("norm").alias("proof"))
    d = d.groupBy("id", *ENTRY).agg(F.count(F.lit(1)).alias("copies"))
    return d.withColumn("run", F.pmod(F.xxhash64("id", "digest"), F.lit(RUNS)).cast("int"))


def merge_runs(runs: DataFrame, best) -> DataFrame:
    """Binomial rounds: each merges neighbouring runs, until run 0 holds everything."""
    runs = runs.repartitionByRange(*ENTRY)
    left = RUNS
    while left > 1:
        left //= 2
        runs = (runs.withColumn("run", F.shiftright("run", 1)).groupBy("run", *ENTRY)
                .agg(best("keep_id").alias("keep_id"), F.sum("size").alias("size")))
    return runs.drop("run")


def decided(docs: DataFrame, id_col: str, text_col: str, keep: str):
    """The written entries, each with the best id and size of its group; the most copies of
    one (id, text) pair."""
    best = {"max": F.max, "min": F.min}[keep]
    entries, seen = materialize_observed(digests(docs, id_col, text_col).repartition("run"),
                                         F.max("copies").alias("most"))
    runs = entries.groupBy("run", *ENTRY).agg(best("id").alias("keep_id"),
                                              F.sum("copies").alias("size"))
    down = runs.select("run", *ENTRY).join(merge_runs(runs, best), ENTRY)
    return entries.join(down, ["run", *ENTRY]), seen["most"] or 0


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              keep: str = "max") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept and the verified digest.

    ``keep`` is "max" or "min": which id of a group stays."""
    entries, _ = decided(docs, id_col, text_col, keep)
    copy_no = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return entries.select("id", "keep_id", "size", *ENTRY, copy_no.alias("copy_no")).select(
        "id", "keep_id", F.col("size").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy_no") == 1)).alias("kept"),
        *ENTRY)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each distinct text."""
    columns = docs.columns
    entries, most = decided(docs, id_col, text_col, keep)
    stay = entries.filter(F.col("id").eqNullSafe(F.col("keep_id")))
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    n = columns_free_of(columns, "id_", "digest", "nbytes", "proof", "stay")
    keyed = docs.withColumns({
        n["id_"]: F.col(id_col), n["digest"]: F.unhex(F.sha2(norm, 256)),
        n["nbytes"]: F.octet_length(norm), n["proof"]: F.xxhash64(norm)})
    stay = stay.select(F.struct("id", *ENTRY).alias(n["stay"]))
    match = F.col(n["id_"]).eqNullSafe(F.col(n["stay"])["id"])
    for c in ENTRY:
        match = match & (F.col(n[c]) == F.col(n["stay"])[c])
    kept = keyed.join(stay, match, "left_semi")
    if most > 1:  # the staying row itself may be repeated
        kept = kept.dropDuplicates([n[c] for c in ENTRY])
    return kept.select(*as_they_are(columns))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return decisions(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE_SQL = """
WITH t AS (SELECT doc_id,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents),
     g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept,
       sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
