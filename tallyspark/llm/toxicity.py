"""Toxicity by noisy-channel deobfuscation: disguised words are restored, the restored text is scored.

1. The character model counts letters over the whole texts of all documents (a fixed number of
   cells, summed by Spark).
2. Labelled documents that aren't held out, at most SAMPLE of them (smallest id hashes), are restored;
   of near copies (equal minima of two hashes over their words) one stands for all.  For every
   restored word the toxic and the other documents that hold it are counted; the words that tell
   them apart beyond what chance brings among so many words are chosen, and a ridge regression
   gives them their weights.
3. Every whole text is restored unit by unit (``noisy_channel``) and scored by the chosen words in it.

What reaches the driver: the cells of the character model and the sample's candidate words by
document.  Inputs of a score are texts only.  Defined results: NULL or empty text scores like a text
without any of the words; a NULL id counts as the empty string for the held-out rule, and takes no
label; NULL labels don't count; an id with several labels counts as toxic if one says so; repeated
rows each give a row; without labelled documents of both kinds every score is the share of
toxic ones (0.5 without any); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.noisy_channel import CELLS, Restorer, cell_counts, costs, units
from tallyspark.operators.materialize import materialize

FOLDS = 5
HELD_OUT_FOLD = 0
SAMPLE = 20_000              # labelled documents that the classifier is fitted on
LEAST_DOCS = 3               # toxic documents that hold a candidate word
LEAST_DEVIANCE = 8.0         # twice the log likelihood ratio that a word has to reach, beyond the
#                              largest that chance brings among V words, 2 log V
RIDGE = 0.02
CACHED = 200_000             # units whose restoration a worker remembers, and again of older ones
CACHED_LENGTH = 64


def held_out(id_col: Column) -> Column:
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)) == HELD_OUT_FOLD


def character_costs(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Costs of the character model over the whole texts of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                texts = [t.as_py() for t in b.column("text").slice(at, 256) if t.is_valid]
                total += cell_counts(b"\n".join(texts))
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(total[cell], pa.int64())], ["cell", "n"])

    rows = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "cell int, n long")
    counts = np.zeros(CELLS, np.int64)
    for r in rows.groupBy("cell").agg(F.sum("n").alias("n")).toPandas().itertuples():   # at most CELLS rows
        counts[r.cell] = r.n
    return costs(counts)


class Reader:
    """Restored words of texts (of ``wanted`` words, where given), remembering the units of short length.  When the
    memory is full, the units that haven't been met since it was last full go."""

    def __init__(self, cost: np.ndarray, wanted: frozenset[str] | None = None):
        self.restorer, self.wanted = Restorer(cost), wanted
        self.seen: dict[str, tuple[str, ...]] = {}
        self.older: dict[str, tuple[str, ...]] = {}

    def words(self, text: str) -> set[str]:
        out, seen = set(), self.seen
        for unit in units(text):
            words = seen.get(unit)
            if words is None:
                words = self.older.get(unit)
                if words is None:
                    words = self.restorer.words(unit)
                    if self.wanted is not None:
                        words = tuple(w for w in words if w in self.wanted)
                if len(unit) <= CACHED_LENGTH:
                    if len(seen) >= CACHED:
                        self.older, self.seen = seen, {}
                        seen = self.seen
                    seen[unit] = words
            if words:
                out.update(words)
        return out


_reader: dict[tuple, Reader] = {}


def reader_of(cost: np.ndarray, wanted: frozenset[str] | None = None) -> Reader:
    """One a worker process, which runs many tasks."""
    key = hashlib.blake2b(cost.tobytes()).digest(), wanted
    if key not in _reader:
        _reader.clear()
        _reader[key] = Reader(cost, wanted)
    return _reader[key]


def restored_words(docs: DataFrame, cost: np.ndarray) -> DataFrame:
    """``docs`` (id, text, more columns) with the array of its different restored words instead of the text."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", words array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = reader_of(cost)
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                words = [sorted(reader.words(t.as_py() or "")) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(f.name) for f in kept], pa.array(words, pa.list_(pa.string()))],
                    [*[f.name for f in kept], "words"])

    return docs.mapInArrow(run, schema)


@dataclass
class Model:
    cost: np.ndarray
    bias: float
    weights: dict[str, float] = field(default_factory=dict)


def fitted_weights(groups: dict[tuple[bool, tuple[str, ...]], int], words: list[str], ridge: float = RIDGE
                   ) -> tuple[float, np.ndarray]:
    """Ridge logistic regression of the label on the words (bias not penalised), by Newton steps over the
    different combinations of label and words."""
    at = {w: i for i, w in enumerate(words)}
    x = np.zeros((len(groups), len(words) + 1))
    x[:, -1] = 1
    for i, (_, on) in enumerate(groups):
        x[i, [at[w] for w in on]] = 1
    y = np.array([toxic for toxic, _ in groups], float)
    n = np.array(list(groups.values()), float)
    penalty = np.full(len(words) + 1, ridge)
    penalty[-1] = 1e-9
    w = np.zeros(len(words) + 1)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((n * (np.logaddexp(0, z) - y * z)).sum() + (penalty * w * w).sum() / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (n * (p - y)) + penalty * w
        step = np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + np.diag(penalty + 1e-9), gradient)
        size, now = 1.0, loss(w)
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(w[-1]), w[:-1]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """The model of ``docs`` by ``labels`` (id, 0/1); held-out ids give no labels."""
    cost = character_costs(docs, text_col)
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
              .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
              .groupBy("id").agg((F.max("label") > 0).alias("toxic"))
              .orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # at most ``sample`` ids and labels are broadcast
    known = materialize(restored_words(texts.join(F.broadcast(chosen), "id"), cost))
    hashes = [F.array_min(F.transform("words", lambda w, seed=seed: F.xxhash64(F.lit(seed), w))) for seed in (1, 2)]
    known = materialize(known.groupBy("toxic", F.struct(*hashes).alias("family"))
                        .agg(F.min_by("words", "id").alias("words")).drop("family"))
    totals = known.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("toxic").cast("long")).alias("pos")).first()
    n, n_pos = totals["n"], totals["pos"] or 0
    if not 0 < n_pos < n:
        share = n_pos / n if n else 0.5
        return Model(cost, float(np.log(max(share, 1e-6)) - np.log(max(1 - share, 1e-6))))
    by_word = materialize(known.select("toxic", F.explode("words").alias("word")).groupBy("word")
                          .agg(F.sum(F.col("toxic").cast("long")).alias("pos"), F.count(F.lit(1)).alias("n")))
    least = LEAST_DEVIANCE + 2 * float(np.log(max(by_word.count(), 1)))
    chosen = by_word.filter((F.col("pos") >= LEAST_DOCS) & (F.col("pos") * n > F.col("n") * n_pos)
                            & (_deviance(F.col("pos"), F.col("n"), n_pos, n) >= least)).select("word")
    # combinations of the chosen words, at most one a document of the sample
    held = (known.withColumn("row", F.monotonically_increasing_id()).select("row", "toxic", F.explode("words").alias("word"))
            .join(chosen, "word", "left_semi").groupBy("row", "toxic").agg(F.sort_array(F.collect_list("word")).alias("words"))
            .groupBy("toxic", "words").agg(F.count(F.lit(1)).alias("n")))
    groups = {(r["toxic"], tuple(r["words"])): r["n"] for r in held.toLocalIterator()}
    for toxic, all_rows in ((True, n_pos), (False, n - n_pos)):
        groups[toxic, ()] = all_rows - sum(c for (t, _), c in groups.items() if t == toxic)
    words = sorted({w for _, on in groups for w in on})
    bias, weights = fitted_weights(groups, words)
    return Model(cost, bias, dict(zip(words, weights.tolist())))


def _deviance(pos: Column, n: Column, n_pos: int, total: int) -> Column:
    def part(x: Column, m: int) -> Column:
        return (F.when(x > 0, x * F.log(x / m)).otherwise(0.0)
                + F.when(x < m, (m - x) * F.log((m - x) / m)).otherwise(0.0))
    return 2 * (part(pos, n_pos) + part(n - pos, total - n_pos) - part(n, total))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score (probability of label 1), words (the chosen words in it)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, score double, words array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, weights = reader_of(model.cost, frozenset(model.weights)), model.weights
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                found = [sorted(reader.words(t.as_py() or "")) for t in part.column("text")]
                z = np.array([model.bias + sum(weights[w] for w in words) for words in found])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500)))),
                     pa.array(found, pa.list_(pa.string()))], ["id", "score", "words"])

    return rows.mapInArrow(run, schema)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    found = score(docs, fit(docs, labels))
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"), "words")
