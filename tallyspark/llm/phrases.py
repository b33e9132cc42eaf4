"""Phrase collocation mining with HAT-trie counts, merged by prefix partition.

1. A task lays the words of its texts into batches of one language each (word numbers of the
   batch's own vocabulary, 0 between pieces).  The words' counts are summed over the corpus;
   the frequent ones get an id, and every batch is told those that it holds.
2. Length by length: a phrase can be frequent only if its first and its last words but one are.
   A batch counts such phrases in a HAT-trie (``hat_trie``); subtrees that memory has no room for,
   and in the end all, leave it as sorted runs, dealt by prefix.  A prefix partition merges its
   sorted runs; a prefix that alone makes up a partition's share is dealt by the last word
   too, so no partition hangs on one prefix.  Frequent phrases get an id and are told to the
   batches that hold them, for the next length.
3. Scores, cuts and containment are joins of the tables of frequent phrases; arithmetic is DECIMAL.

Nothing is collected but the number of words.  Defined results: NULL text counts as empty (no words),
NULL lang as ``und``; repeated rows each count; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.hat_trie import HatTrie
from tallyspark.llm.text import LOWER, UPPER
from tallyspark.operators.materialize import materialize, materialize_observed

MAX_WORDS = 3
MIN_COUNT = 10
CONTAINED_PERCENT = 50       # a longer candidate seen so often takes a shorter one's place
SCALE = 1_000_000
FIRST = 2000
NO_LANG = "und"
BATCH_TOKENS = 1 << 21
PART_TOKENS = 1 << 22        # words whose phrases a prefix partition merges
LEAST_PARTS = 256
TOP_PARTS = 32               # parts of a language that are cut to the first rows on their own
STOPS = b".,;:!?\n\x0b\x0c\r"        # fixed values: where pieces end
STOP = b"\xff"                       # a byte that UTF-8 doesn't have
BYTES = bytes.maketrans(UPPER.encode() + b"\t" + STOPS, LOWER.encode() + b" " + STOP * len(STOPS))


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length, each as byte planes of 64-bit numbers, compressed."""
    rows = np.stack(columns).astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(rows).tobytes())


def unpacked(data: bytes, columns: int) -> np.ndarray:
    """(columns, rows) of ``packed``."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(raw.T).view("<i8").reshape(columns, -1)


def packed_run(prefix: np.ndarray, word: np.ndarray, *more: np.ndarray) -> bytes:
    """A run sorted by (prefix, word); the prefixes as steps."""
    return packed(np.diff(prefix, prepend=0), word, *more)


def unpacked_run(data: bytes, columns: int) -> np.ndarray:
    out = unpacked(data, columns)
    out[0] = np.cumsum(out[0])
    return out


# --- batches ------------------------------------------------------------------------------------

class Open:
    """A batch in the making: texts of one language."""

    def __init__(self):
        self.known, self.parts, self.size = {STOP: 0}, [], 0

    def add(self, data: bytes) -> int:
        words = data.translate(BYTES).replace(STOP, b" \xff ").split()
        code, known = self.known.setdefault, self.known
        codes = [code(w, len(known)) for w in words]
        codes.append(0)
        self.parts.append(np.array(codes, np.int32))
        self.size += len(codes)
        return len(codes)

    def closed(self) -> tuple[bytes, list[str], np.ndarray]:
        codes = np.concatenate(self.parts)
        counts = np.bincount(codes, minlength=len(self.known))
        words = iter(self.known)
        next(words)
        return packed(codes), [w.decode() for w in words], counts[1:]


def batches_of(docs: DataFrame, text_col: str, lang_col: str, batch_tokens: int) -> DataFrame:
    """One row per batch: batch, lang, codes (packed), vocab and counts (of code 1, 2, ...), n_words."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.col(text_col).cast("binary").alias("text"))
    schema = "batch long, lang string, codes binary, vocab array<string>, counts array<long>, n_words long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, total = TaskContext.get().partitionId() << 32, {}, 0

        def row(lang: str) -> pa.RecordBatch:
            codes, vocab, counts = held.pop(lang).closed()
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([lang]), pa.array([codes], pa.binary()),
                 pa.array([vocab], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([int(counts.sum())], pa.int64())],
                ["batch", "lang", "codes", "vocab", "counts", "n_words"])

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                if lang not in held:
                    held[lang] = Open()
                total += held[lang].add(text.as_py() or b"")
                if total >= batch_tokens:
                    most = max(held, key=lambda k: held[k].size)
                    total -= held[most].size
                    yield row(most)
                    number += 1
        for lang in list(held):
            yield row(lang)
            number += 1

    return rows.mapInArrow(run, schema)


# --- counting phrases -----------------------------------------------------------------------------

class Told:
    """What a batch knows: its frequent words and phrases, with ids and counts, by position."""

    def __init__(self, row: dict, told: pa.Table, words: int):
        codes = unpacked(row["codes"], 1)[0]
        level = told.column("level").to_numpy()
        first = np.flatnonzero(level == 1)
        code, ids, n = (told.column(c).to_numpy()[first] for c in ("code", "id", "n"))
        order = np.argsort(ids)
        self.ids, self.n = self.word_ids, _ = ids[order], n[order]
        rank = np.full(int(codes.max(initial=0)) + 1, -1, np.int64)
        rank[code[order]] = np.arange(len(order))
        self.word = rank[codes]
        self.node, self.words = self.word, 1
        for k in range(2, words):
            self._longer(told.filter(pa.array(level == k)).column("blob").to_pylist())

    @property
    def width(self) -> int:
        return max(len(self.word_ids), 1)

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases one word longer stand whose first and last words are frequent, and their
        numbers."""
        n, k = len(self.word), self.words
        at = np.flatnonzero((self.node[:max(n - k, 0)] >= 0) & (self.node[1:n - k + 1] >= 0)) if n > k else \
            np.zeros(0, np.int64)
        return at, self.node[at] * self.width + self.word[at + k]

    def _longer(self, blobs: list[bytes]) -> None:
        at, numbers = self.numbers()
        none = np.zeros((4, 0), np.int64)
        prefix, word, ids, n = np.concatenate([none, *[unpacked_run(b, 4) for b in blobs]], axis=1)
        order = np.argsort(ids)
        key = np.searchsorted(self.ids, prefix[order]) * self.width + np.searchsorted(self.word_ids, word[order])
        by_key = np.argsort(key)
        self.node = np.full(len(self.word), -1, np.int64)
        if len(key):
            place = np.minimum(np.searchsorted(key[by_key], numbers), len(key) - 1)
            found = key[by_key][place] == numbers
            self.node[at[found]] = by_key[place[found]]
        self.ids, self.n, self.words = ids[order], n[order], self.words + 1


def mixed(x: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x.view(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(parts)).view(np.int64)


def phrase_runs(batches: DataFrame, told: DataFrame, words: int, parts: int, hot: int) -> DataFrame:
    """Sorted runs (part, batch, blob) of the counts of phrases of ``words`` words.  Phrases with a prefix
    that is seen ``hot`` times or more are dealt by the last word too."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        part_col, batch_col, blobs = [], [], []
        for row in left.to_pylist():
            known = Told(row, right, words)
            trie = HatTrie(len(known.ids) * known.width, known.width)

            def leave(numbers: np.ndarray, n: np.ndarray) -> None:
                prefix, word = known.ids[numbers // known.width], known.word_ids[numbers % known.width]
                split = known.n[numbers // known.width] >= hot
                part = mixed(np.where(split, prefix * 1_000_003 + word, prefix), parts)
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
                for a, b in zip(cuts, np.append(cuts[1:], len(order))):
                    rows = order[a:b]
                    part_col.append(int(part[rows[0]]))
                    batch_col.append(row["batch"])
                    blobs.append(packed_run(prefix[rows], word[rows], n[rows]))

            _, numbers = known.numbers()
            for spilled in trie.add(numbers):
                leave(*spilled)
            for spilled in trie.rest():
                leave(*spilled)
        return pa.table({"part": pa.array(part_col, pa.int64()), "batch": pa.array(batch_col, pa.int64()),
                         "blob": pa.array(blobs, pa.binary())})

    of = told.withColumnRenamed("batch", "of")
    return (batches.select("batch", "codes").groupBy("batch").cogroup(of.groupBy("of"))
            .applyInArrow(run, "part long, batch long, blob binary"))


def merged(runs: DataFrame, min_count: int, last: bool) -> DataFrame:
    """The frequent phrases: rows (prefix, word, id, n), and but for the last length the answers to the batches
    that hold them: rows (batch, blob of prefix, word, id, n)."""
    def run(key: tuple, group: pa.Table) -> pa.Table:
        part, read = key[0].as_py(), [unpacked_run(b.as_py(), 3) for b in group.column("blob")]
        prefix, word, n = np.concatenate(read, axis=1)
        batch = np.repeat(group.column("batch").to_numpy(), [r.shape[1] for r in read])
        prefixes, p = np.unique(prefix, return_inverse=True)
        words, w = np.unique(word, return_inverse=True)
        number = p * len(words) + w
        order = np.argsort(number, kind="stable")           # a merge: it goes along the sorted runs
        starts = np.flatnonzero(np.diff(number[order], prepend=-1))
        total = np.add.reduceat(n[order], starts)
        often = total >= min_count
        found = number[order][starts][often]
        prefix, word, n = prefixes[found // len(words)], words[found % len(words)], total[often]
        ids = (part << 32) + np.arange(len(found))
        cols = {"prefix": prefix, "word": word, "id": ids, "n": n}
        out = [pa.table(cols | {"batch": pa.nulls(len(ids), pa.int64()), "blob": pa.nulls(len(ids), pa.binary())})]
        if not last and len(found):
            sizes = np.diff(starts, append=len(order))
            kept = np.repeat(often, sizes)
            holder = batch[order][kept]
            of = np.repeat(np.arange(len(found)), sizes[often])
            pairs = np.unique(np.stack([holder, of], 1), axis=0)
            cuts = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1))
            blobs = [packed_run(*(c[pairs[a:b, 1]] for c in cols.values()))
                     for a, b in zip(cuts, np.append(cuts[1:], len(pairs)))]
            gone = pa.nulls(len(blobs), pa.int64())
            out.append(pa.table({c: gone for c in cols} | {"batch": pairs[cuts, 0], "blob": pa.array(blobs, pa.binary())}))
        return pa.concat_tables(out)

    return runs.groupBy("part").applyInArrow(run, "prefix long, word long, id long, n long, batch long, blob binary")


# --- tables of frequent phrases ---------------------------------------------------------------------

def _longer_phrases(found: DataFrame, shorter: DataFrame) -> DataFrame:
    """(id, prefix, suffix, word, n) joined with what the phrases one word shorter know: id, suffix, prefix,
    words, lang, heads (counts of the first 1, 2, ... words) and tails (of the last ones)."""
    first = shorter.select(F.col("id").alias("prefix"), F.col("suffix").alias("middle"), "lang",
                           F.col("words").alias("first_words"), F.col("heads").alias("first_heads"))
    last = shorter.select(F.col("prefix").alias("middle"), "word", F.col("id").alias("suffix"),
                          F.col("tails").alias("last_tails"), F.element_at("words", -1).alias("last_word"))
    own = F.array("n")
    return (found.join(first, "prefix").join(last, ["middle", "word"])
            .select("id", "prefix", "suffix", "word", "n", "lang",
                    F.concat("first_words", F.array("last_word")).alias("words"),
                    F.concat("first_heads", own).alias("heads"), F.concat("last_tails", own).alias("tails")))


def _scored(phrases: DataFrame, words: int, scale: int) -> DataFrame:
    """(lang, id, phrase, a, l, r, score) by the cut with the lowest score, the first of equal ones."""
    cuts = []
    for k in range(1, words):
        left, right = F.col("heads")[k - 1], F.col("tails")[words - k - 1]
        product = F.col("n").cast("decimal(15,0)") * F.col("n").cast("decimal(15,0)")
        score = F.expr(f"CAST(n AS DECIMAL(15,0)) * CAST(n AS DECIMAL(15,0)) * CAST({scale} AS DECIMAL(7,0)) div "
                       f"(CAST(heads[{k - 1}] AS DECIMAL(15,0)) * CAST(tails[{words - k - 1}] AS DECIMAL(15,0)))")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    best = F.array_min(F.array(*cuts))
    return phrases.withColumn("cut", best).select(
        "lang", "id", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"), "cut.l", "cut.r", "cut.score")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
         min_count: int = MIN_COUNT, contained_percent: int = CONTAINED_PERCENT, scale: int = SCALE,
         batch_tokens: int = BATCH_TOKENS, least_parts: int = LEAST_PARTS) -> DataFrame:
    """Every phrase of 2 to ``max_words`` words that stays: lang, phrase, a, l, r, n, score."""
    batches, seen = materialize_observed(batches_of(docs, text_col, lang_col, batch_tokens),
                                         F.sum("n_words").alias("words"))
    total = seen["words"] or 0
    parts = least_parts + total // PART_TOKENS
    hot = max(total // parts, 1)
    rows = (batches.select("batch", "lang", F.posexplode(F.arrays_zip("vocab", "counts")).alias("at", "w"))
            .select("batch", "lang", (F.col("at") + 1).alias("code"), F.col("w.vocab").alias("word"),
                    F.col("w.counts").alias("n")))
    words = materialize(rows.groupBy("lang", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
                        .withColumn("id", F.monotonically_increasing_id()))
    told = materialize(rows.select("batch", "lang", "code", "word").join(words, ["lang", "word"])
                       .select("batch", F.lit(1).alias("level"), "code", "id", "n",
                               F.lit(None).cast("binary").alias("blob")))
    own = F.array("n")
    nothing = F.lit(-1).cast("long")
    tables = [words.select("id", nothing.alias("prefix"), nothing.alias("suffix"), F.col("id").alias("word"), "n",
                           "lang", F.array("word").alias("words"), own.alias("heads"), own.alias("tails"))]
    for k in range(2, max_words + 1):
        found = materialize(merged(phrase_runs(batches, told, k, parts, hot), min_count, k == max_words))
        table = found.filter("batch IS NULL").select("prefix", "word", "id", "n")
        tables.append(materialize(_longer_phrases(table, tables[-1])))
        answers = found.filter("batch IS NOT NULL").select("batch", F.lit(k).alias("level"), F.lit(0).alias("code"),
                                                           "id", "n", "blob")
        told = told.unionByName(answers)
    kept = None
    for k in range(2, max_words + 1):
        rows = _scored(tables[k - 1], k, scale)
        if k < max_words:
            # of all longer candidates that hold a phrase those one word longer are seen most often
            holders = tables[k].select(F.explode(F.array("prefix", "suffix")).alias("id"), "n")
            most = holders.groupBy("id").agg(F.max("n").alias("most"))
            rows = rows.join(most, "id", "left").filter(
                F.col("most").isNull() | (100 * F.col("most") < contained_percent * F.col("a"))).drop("most")
        kept = rows if kept is None else kept.unionByName(rows)
    by_lang = batches.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return kept.join(by_lang, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def first_of_each(phrases: DataFrame, first: int) -> DataFrame:
    """The first rows of each language with their rank; a language is cut in parts before it is
    ranked as a whole."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    inside = Window.partitionBy("lang", "part").orderBy(*order)
    ahead = (phrases.withColumn("part", part).withColumn("rank", F.row_number().over(inside))
             .filter(F.col("rank") <= first).drop("part", "rank"))
    over_all = Window.partitionBy("lang").orderBy(*order)
    return (ahead.withColumn("rank", F.row_number().over(over_all).cast("long"))
            .filter(F.col("rank") <= first))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")
    return first_of_each(mine(docs), FIRST).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = """
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS g
  FROM split, (VALUES (1), (2), (3)) AS lengths(k) WHERE len(ws) >= k
), f AS (
  SELECT lang, k, g, count(*)::HUGEINT AS c FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, g, c AS a, string_split(g, ' ') AS ws FROM f WHERE k >= 2 AND c >= 10
), cuts AS (
  SELECT lang, k, g, a, ws, unnest(range(1, k)) AS cut FROM cand
), sides AS (
  SELECT c.lang, c.k, c.g, c.a, c.cut, l.c AS l, r.c AS r, (1000000 * c.a * c.a) // (l.c * r.c) AS score
  FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.k = c.cut AND l.g = array_to_string(c.ws[1:c.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.k = c.k - c.cut AND r.g = array_to_string(c.ws[c.cut + 1:c.k], ' ')
), best AS (
  SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, array_to_string(ws[i:i + 1], ' ') AS g, max(a) AS most
  FROM cand, (VALUES (1), (2)) AS starts(i) WHERE k = 3 GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON b.k = 2 AND i.lang = b.lang AND i.g = b.g
  WHERE i.most IS NULL OR 100 * i.most < 50 * b.a
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank,
         g AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, score::BIGINT AS score FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
