"""Packing token pieces into windows by non-negative least squares over the length histogram.

1. Tokenise: a document's ids (the encoder's ids, then END_ID) are cut into full windows and a
   tail.  Each piece is a row; a tail keeps its ids, since it may be cut once more.
2. The histogram of the lengths (at most WINDOW numbers, whatever the input) goes to the driver.
   Shallow combinations of up to DEPTH lengths that fill a window are enumerated over it, and
   ``min |A x - h|`` over ``x >= 0`` is solved for their repeat counts by projected gradient
   steps; the counts are rounded down.
3. What the rounding leaves is packed greedily, on counts still: the largest length is combined
   with the largest ones that fit, and a gap that no length fits is filled by cutting a piece.  A
   pattern is repeated as often as its lengths allow, so the number of patterns doesn't
   depend on the number of pieces.  The last, partly filled window is cut at powers of two,
   where no padding is needed.
4. Every piece gets its rank among the pieces of its length (counts by bucket, summed up, plus
   the position in the bucket), and the rank says which repeat of which pattern it fills.

Defined results: NULL text is empty and gives the single id END_ID; repeated rows give pieces
of their own; an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.bpe_words import ByteBpe, are_plain, plain  # noqa: F401
from tallyspark.llm.text import text_key
from tallyspark.operators.materialize import materialize

WINDOW = 1024
END_ID = 0
DEPTH = 3
STEPS = 300          # projected gradient steps of the least squares
BUCKETS = 4096         # row buckets in which a length's pieces are ranked
RANK_BITS = 48         # of a rank; the length is kept above it
CACHE_BYTES = 1 << 26     # of words and their ids that a worker remembers, and again of older ones
ENTRY_BYTES = 200         # what an entry of the cache takes besides
TEXTS = 3 << 9            # texts whose words are looked up together
TEXT_BYTES = 1 << 23      # and their bytes, unless one text alone has more
NEW_WORDS = 1 << 14       # words that are encoded together
JOINED = 1 << 8           # texts whose words' ids are put together at once
# How far the two smaller lengths of a combination of three lie apart; fixed values that keep
# the combinations few enough for whole repeat counts.
SPREADS = (0, 2, 6, 20, 62, 200, 632)


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of runs, one run after another: steps of one, but for those from run to run."""
    starts, sizes = starts[sizes > 0], sizes[sizes > 0]
    out = np.ones(int(sizes.sum()), np.int64)
    if len(out):
        out[0] = starts[0]
        out[np.cumsum(sizes[:-1])] = starts[1:] - (starts + sizes - 1)[:-1]
    return np.cumsum(out, out=out)


class Known:
    """Words and their ids, one word's after another's."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.number)

    def numbers(self, words: Iterable[str], n: int) -> np.ndarray:
        """The words' numbers, or -1."""
        return np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, n)

    def add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Words that aren't known."""
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(sizes))
        self.ids = np.append(self.ids, ids)


class Encoder:
    """Ids of the ``tokenizers`` library for whole texts, as little-endian unsigned 32-bit.

    Texts whose blanks all stand alone are encoded word by word (``bpe_words``): words seen before come
    from a cache of bounded bytes, the new ones of many texts are encoded together.  When the cache
    is full, the words that haven't been met since it was last full go.  All other texts, and those
    that hold a special string, are encoded whole."""

    def __init__(self, path: str):
        self.bpe = ByteBpe(path)
        self.cache, self.older = Known(), Known()
        self.size = 0

    def encode_many(self, texts: list[str]) -> list[bytes]:
        wordwise = [bool(t) and self.bpe.wordwise(t) for t in texts]
        split = pc.split_pattern(pa.array([t for t, w in zip(texts, wordwise) if w], pa.large_string()), " ")
        at, found = split.offsets.to_numpy(), split.flatten().dictionary_encode()
        code, words = found.indices.to_numpy(), found.dictionary.to_numpy(zero_copy_only=False).tolist()
        # the first word has no blank before it
        is_first = np.zeros(len(code), bool)
        is_first[at[:-1]] = True
        first = iter([words[c] for c in code[is_first]])
        whole = iter(self.bpe.wholes([next(first) if w else t for t, w in zip(texts, wordwise)]))
        ids, start, size = self._words(words, found.dictionary)
        del split, found, words
        rests = self._joined(ids, start, size, code, is_first, at)
        return [next(whole).tobytes() + (next(rests) if w else b"") for w in wordwise]

    @staticmethod
    def _joined(ids: np.ndarray, start: np.ndarray, size: np.ndarray, code: np.ndarray, is_first: np.ndarray,
                at: np.ndarray) -> Iterator[bytes]:
        """The ids of each text's words without the first: ``code`` numbers the words, ``at`` is where texts begin."""
        for group in (at[i:i + JOINED + 1] for i in range(0, len(at) - 1, JOINED)):
            own = code[group[0]:group[-1]]
            n = np.where(is_first[group[0]:group[-1]], 0, size[own])
            ends = np.append(0, np.cumsum(n))[group - group[0]].tolist()
            rest = ids[spans(start[own], n)]
            yield from (rest[a:b].tobytes() for a, b in zip(ends, ends[1:]))

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def _words(self, words: list[str], column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of " " + word for each of the different words (which are also the column's): where a
        word's ids begin, and how many they are."""
        start, size = np.empty((2, len(words)), np.int64)
        parts, end = [], 0

        def take(at: np.ndarray, ids: np.ndarray, starts: np.ndarray, number: np.ndarray) -> None:
            nonlocal end
            start[at], size[at] = starts[number] + end, np.diff(starts)[number]
            parts.append(ids)
            end += len(ids)

        number = self.cache.numbers(words, len(words))
        at, other = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
        take(at, self.cache.ids, self.cache.starts, number[at])
        number = self.older.numbers(map(words.__getitem__, other.tolist()), len(other))
        old, new = other[number >= 0], other[number < 0]
        take(old, self.older.ids, self.older.starts, number[number >= 0])
        column = column.take(pa.array(new))
        is_plain, is_ascii = are_plain(column), pc.string_is_ascii(column).to_numpy(zero_copy_only=False)
        for group, encode in ((new[is_plain & is_ascii], self.bpe.plain_words), (new[is_plain & ~is_ascii], self.bpe.plain_words),
                              (new[~is_plain], self.bpe.words)):
            for first in range(0, len(group), NEW_WORDS):
                part = group[first:first + NEW_WORDS]
                take(part, *encode([words[i] for i in part.tolist()]), np.arange(len(part)))
        ids = np.concatenate(parts)
        for at in (old, new):
            self._remember([words[i] for i in at.tolist()], ids, start[at], size[at])
        return ids, start, size

    def _remember(self, words: list[str], ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        cost = np.fromiter(map(len, words), np.int64, len(words)) + 4 * size + ENTRY_BYTES
        total, at = np.append(0, np.cumsum(cost)), 0
        while at < len(words):
            fit = int(np.searchsorted(total, total[at] + CACHE_BYTES - self.size, side="right")) - 1
            if fit > at:
                self.cache.add(words[at:fit], ids[spans(start[at:fit], size[at:fit])], size[at:fit])
                self.size += int(total[fit] - total[at])
            elif self.size:
                self.cache, self.older, self.size = Known(), self.cache, 0
            else:                             # a word that no cache holds
                fit += 1
            at = fit


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One a worker process, which runs many tasks."""
    return Encoder(path)


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    end, at = np.append(0, np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))), 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(end, end[at] + TEXT_BYTES, side="right")) - 1
        stop = min(max(stop, at + 1), at + TEXTS)
        yield batch.slice(at, stop - at)
        at = stop


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           window: int = WINDOW) -> DataFrame:
    """One row per piece: id, key, start, length, crc, doc_tokens, tail (ids of a piece shorter
    than the window, little-endian unsigned 32-bit)."""
    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = (f"id {rows.schema['id'].dataType.simpleString()}, key binary, start long, length int, "
              "crc long, doc_tokens long, tail binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(tokenizer_path), np.array([END_ID], "<u4").tobytes()
        for b in batches:
            for part in parts_of(b):
                of, start, length, crc, total, tail = [], [], [], [], [], []
                for i, ids in enumerate(encoder.encode_many(part.column("text").to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    for s in range(0, n, window):
                        piece = ids[4 * s:4 * (s + window)]
                        of.append(i)
                        start.append(s)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        tail.append(piece if len(piece) < 4 * window else None)
                at_row = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(at_row), part.column("key").take(at_row),
                     pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                     pa.array(crc, pa.int64()), pa.array(total, pa.int64()),
                     pa.array(tail, pa.binary())],
                    ["id", "key", "start", "length", "crc", "doc_tokens", "tail"])

    return rows.mapInArrow(run, schema)


# --- the plan on the driver: works on at most WINDOW counts ---------------------------------

def combinations(lengths: np.ndarray, window: int = WINDOW, depth: int = DEPTH) -> np.ndarray:
    """Rows of two or three (zero-filled) lengths, all of them present, that fill the window."""
    present = np.zeros(window + 1, bool)
    present[lengths] = True
    present[0] = True
    a = np.arange(1, window // 2 + 1)
    rows = [np.stack([window - a, a, np.zeros_like(a)], 1)]
    if depth >= 3:
        big = np.arange(1, window - 1)
        for apart in SPREADS:
            low = (window - big - apart) // 2
            mid = window - big - low
            ok = (low >= 1) & (mid < window)
            rows.append(np.sort(np.stack([big, mid, low], 1)[ok], axis=1)[:, ::-1])
    out = np.unique(np.concatenate(rows), axis=0)
    return out[present[out].all(axis=1)]


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Projected gradient for ``min |A x - h|, x >= 0`` (Nesterov steps), rounded down so that
    no length is used more often than it occurs."""
    if not len(combos):
        return np.zeros(0, np.int64)
    size = len(histogram)
    h = histogram.astype(float)
    h[0] = 0

    def total(x):
        out = np.zeros(size)
        for c in range(combos.shape[1]):
            out += np.bincount(combos[:, c], weights=x, minlength=size)
        out[0] = 0
        return out

    degree = total(np.ones(len(combos)))
    step = 1.0 / (combos.shape[1] * max(degree.max(), 1.0))  # at least the largest eigenvalue
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        gap = total(y) - h
        new = np.maximum(0.0, y - step * gap[combos].sum(axis=1))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    over = total(x) / np.maximum(h, 1e-9)      # scale down where a length is asked for too often
    worst = np.where(combos > 0, over[combos], 0).max(axis=1)
    return np.floor(x / np.maximum(worst, 1.0) + 1e-9).astype(np.int64)


def plan_windows(histogram: np.ndarray, window: int = WINDOW) -> tuple[list[tuple], list[tuple]]:
    """``histogram[l]`` pieces of length l -> (fills, cuts) as intervals of ranks by length.

    fill: (length, first rank, count, first sequence, offset): the ranks from ``first`` on go to
    consecutive sequences at that offset.  cut: (length, first rank, count, head, child rank):
    those pieces are cut after ``head`` ids; the heads become pieces of length ``head`` and the
    rests of length ``length - head`` with consecutive ranks from the two child ranks on."""
    left = histogram.astype(np.int64).copy()
    used = np.zeros(window + 1, np.int64)     # ranks handed out so far
    known = left.copy()                       # ranks that exist so far
    fills, cuts, sequence = [], [], 0

    def fill(lengths: list[int], count: int) -> None:
        nonlocal sequence
        offset = 0
        for n in lengths:
            fills.append((n, int(used[n]), count, sequence, offset))
            used[n] += count
            left[n] -= count
            offset += n
        sequence += count

    def cut(n: int, head: int, count: int) -> None:
        cuts.append((n, int(used[n]), count, head, int(known[head]),
                     int(known[n - head] + (count if head == n - head else 0))))
        used[n] += count
        left[n] -= count
        for part in (head, n - head):
            known[part] += count
            left[part] += count

    if left[window]:
        fill([window], int(left[window]))
    combos = combinations(np.flatnonzero(left[1:]) + 1, window)
    for row, count in zip(combos.tolist(), repeat_counts(combos, left).tolist()):
        lengths = [n for n in row if n]
        count = min([count] + [int(left[n]) // lengths.count(n) for n in set(lengths)])
        if count:
            fill(lengths, count)
    while left.any():
        lengths, room, need = [], window, np.zeros_like(left)
        while room:
            fits = np.flatnonzero(left[1:room + 1] > need[1:room + 1]) + 1
            if not len(fits):
                break
            n = int(fits[-1])
            lengths.append(n)
            need[n] += 1
            room -= n
        more = np.flatnonzero(left > need)
        if room and len(more):               # every other piece is too long for the gap: cut one
            n = int(more[-1])
            by = [int(left[m]) // (int(need[m]) + (m == n)) for m in {*lengths, n}]
            cut(n, room, max(1, min(by)))
        elif room:                           # the last window: powers of two need no padding
            size = window
            while lengths:
                size = 1 << (min(sum(lengths), window).bit_length() - 1)
                taken, got = [], 0
                while got < size:
                    n = lengths.pop(0)
                    if n > size - got:
                        cut(n, size - got, 1)
                        lengths.insert(0, n - (size - got))
                        n = size - got
                    taken.append(n)
                    got += n
                fill(taken, 1)
        else:
            fill(lengths, min(int(left[n]) // int(need[n]) for n in set(lengths)))
    return fills, cuts


class Placement:
    """Looks up where the piece of a length and rank goes; vectorised over pieces."""

    def __init__(self, fills: list[tuple], cuts: list[tuple]):
        rows = sorted([(n, first, 0, sequence, offset) for n, first, _, sequence, offset in fills]
                      + [(n, first, head, a, b) for n, first, _, head, a, b in cuts])
        length, self.first, self.head, self.a, self.b = np.array(rows, np.int64).reshape(-1, 5).T
        self.keys = (length << RANK_BITS) + self.first

    def places(self, length: np.ndarray, rank: np.ndarray, start: np.ndarray) -> np.ndarray:
        """(piece, start, length, sequence, offset) of the parts the pieces end up in, by piece and start."""
        piece, out = np.arange(len(length)), [np.zeros((5, 0), np.int64)]
        while len(piece):
            at = np.searchsorted(self.keys, (length << RANK_BITS) + rank, side="right") - 1
            head, a, b, more = self.head[at], self.a[at], self.b[at], rank - self.first[at]
            out.append(np.stack([piece, start, length, a + more, b])[:, head == 0])
            cut = head > 0
            piece, start = np.tile(piece[cut], 2), np.append(start[cut], (start + head)[cut])
            length, rank = np.append(head[cut], (length - head)[cut]), np.append((a + more)[cut], (b + more)[cut])
        parts = np.concatenate(out, axis=1)
        return parts[:, np.lexsort(parts[1::-1])]

    def place(self, length: int, rank: int, start: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the parts the piece ends up in."""
        parts = self.places(*(np.array([x], np.int64) for x in (length, rank, start)))
        return [tuple(p) for p in parts[1:].T.tolist()]


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with each piece's rank among the pieces of its length, without bringing a length
    into one task: counts by (bucket, length) give the bucket's first rank."""
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id", "key", "start"), F.lit(BUCKETS)))
    counts = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "bucket",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("id", "key", "start")
    return (rows.withColumn("at", F.row_number().over(inside) - 1)
            .join(firsts, ["length", "bucket"])
            .withColumn("rank", F.col("first") + F.col("at")).drop("first", "at", "bucket"))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW) -> DataFrame:
    """One row per packed piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = materialize(pieces(docs, tokenizer_path, id_col, text_col, window))
    histogram = np.zeros(window + 1, np.int64)
    for r in rows.groupBy("length").count().collect():  # at most ``window`` rows
        histogram[r["length"]] = r["count"]
    placement = Placement(*plan_windows(histogram, window))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = (f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start, length, crc, rank = (b.column(k).to_numpy().astype(np.int64) for k in ("start", "length", "crc", "rank"))
            of, s, n, sequence, offset = placement.places(length, rank, start)
            part = crc[of]
            for i in np.flatnonzero(n != length[of]).tolist():
                tail, at = b.column("tail")[int(of[i])].as_py(), 4 * int(s[i] - start[of[i]])
                part[i] = zlib.crc32(tail[at:at + 4 * int(n[i])])
            at = pa.array(of)
            s, n, crc, sequence, offset = map(pa.array, (s, n, part, sequence, offset))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(at), s, n, crc, b.column("doc_tokens").take(at), sequence, offset],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked(rows).mapInArrow(run, schema)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    packed = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumnRenamed("id", "doc_id")
