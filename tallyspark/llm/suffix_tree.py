"""Language-model scoring with a probabilistic suffix tree over words.

A state is a context of up to ``max_depth`` words.  Candidate contexts are those seen MIN_SUPPORT times in
the training tokens (in a small corpus already those that make up MIN_SHARE of it), so that their
number grows with the corpus; a candidate becomes a state when the distribution of its next
tokens diverges significantly from that of its suffix.  A state's distribution is interpolated
with that of its next shorter state, down to add-one smoothed unigrams, and a token is scored
in the longest suffix of its history that is a state.

How the work is laid out: texts are tokenised once into batches of about BATCH_TOKENS tokens
(a row each: token codes into the batch's own vocabulary).  The words' counts are summed over the
corpus, and every batch is told the ids and counts of its words that other batches hold too (it
knows the others itself).  Then, length by length, a batch counts the next tokens of its candidate
contexts and hands them out as compressed sorted runs, dealt by context (by next word too where a
context alone makes up a partition's share).  Beside its own count a row carries what the divergence
test needs of the suffix, so the partition that merges the runs of a context can test it on the
spot.  The sums of pairs that several batches hold, and the ids of those that are candidates of
the next length, go back to these batches the same way.  No vocabulary, candidate or state table
is broadcast or collected.

Words and contexts are told apart by ids, not by hashes.  Defined results: NULL text counts as empty (its
one token is the end); a NULL id counts as the empty string for the held-out rule; repeated rows each
count and each give a row; without training documents every probability is 1; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.phrases import mixed, packed_run, unpacked_run
from tallyspark.operators.materialize import discard, materialize, materialize_observed

FOLDS = 7
HELD_OUT_FOLD = 2
BATCH_TOKENS = 1 << 21
PART_TOKENS = 1 << 22        # training tokens whose contexts a partition merges
LEAST_PARTS = 256
MAX_DEPTH = 3
MIN_SUPPORT = 400            # a context seen so often is a candidate, however large the corpus
MIN_SHARE = 1e-3             # in a small corpus: so large a share of its training tokens
# A cell of the divergence test counts when it is seen or expected this often; the deviance has
# to exceed its expectation by so many standard deviations.
MIN_CELL = 5
DEVIATIONS = 3.0
MIN_NEXT = 2                 # a next word seen less often is left to the shorter state
LEVEL = 3                    # of the compression of codes, which are written once and read at every length
CODE_BITS = 24               # of the ids that a batch gives to words of its own


def held_out(id_col: Column) -> Column:
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)) == HELD_OUT_FOLD


def packed(codes: np.ndarray) -> bytes:
    """Codes as compressed byte planes: frequent words have small codes, so the upper planes
    hold next to nothing."""
    planes = codes.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=LEVEL).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


END = np.zeros(1, "<i4")


def vocabulary() -> defaultdict:
    """Codes of words by their first occurrence; the end has code 0."""
    return defaultdict(count(1).__next__, {b"": 0})


def batches_of(docs: DataFrame, id_col: str, text_col: str, batch_tokens: int) -> DataFrame:
    """One row per batch: batch, ids, held, lens, codes (packed), vocab (words by code), counts
    (training tokens by code).  Every text ends with code 0, the empty word."""
    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held"),
                       F.col(text_col).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = (f"batch long, ids array<{id_type}>, held array<boolean>, lens array<int>, codes binary, "
              "vocab array<binary>, counts array<long>")

    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 14
        ids, held, lens, parts, known, size = [], [], [], [], vocabulary(), 0
        types = None

        def made() -> pa.RecordBatch:
            codes = np.concatenate(parts)
            train = np.repeat(~np.array(held, bool), lens)
            counts = np.bincount(codes[train], minlength=len(known))
            cols = {"batch": [number], "ids": [ids], "held": [held], "lens": [lens],
                    "codes": [packed(codes)], "vocab": [list(known)], "counts": [counts]}
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols.values(), types)], list(cols))

        for b in rows_in:
            if types is None:
                types = [pa.int64(), pa.list_(b.schema.field("id").type), pa.list_(pa.bool_()),
                         pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            for i, h, text in zip(b.column("id").to_pylist(), b.column("held").to_pylist(), b.column("text")):
                words = (text.as_py() or b"").lower().split()
                parts.append(np.fromiter(map(known.__getitem__, words), "<i4", len(words)))
                parts.append(END)
                ids.append(i)
                held.append(h)
                lens.append(len(words) + 1)
                size += len(words) + 1
                if size >= batch_tokens:
                    yield made()
                    number += 1
                    ids, held, lens, parts, known, size = [], [], [], [], vocabulary(), 0
        if ids:
            yield made()

    return rows.mapInArrow(run, schema)


def with_words(batches: DataFrame, told: DataFrame) -> DataFrame:
    """The batches with ``words`` (packed: id and corpus count by code) in place of vocabulary and counts.
    ``told`` has (of, code, id, c) of the words that several batches hold; a batch's own words get ids
    that no other batch gives."""
    id_type = batches.schema["ids"].dataType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        code, ids, c = (right.column(n).to_numpy() for n in ("code", "id", "c"))
        out = []
        for b in left.to_batches():
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                total = row.column("counts")[0].values.to_numpy().copy()
                own = np.arange(len(total), dtype=np.int64)
                own = -1 - (row.column("batch")[0].as_py() << CODE_BITS) - own
                own[code], total[code] = ids, c
                out.append(pa.Table.from_batches([row.drop_columns(["counts"])]).append_column(
                    "words", pa.array([packed_run(own, total)], pa.binary())))
        return pa.concat_tables(out)

    return (batches.select("batch", "ids", "held", "lens", "codes", "counts").groupBy("batch")
            .cogroup(told.groupBy("of"))
            .applyInArrow(run, f"batch long, ids {id_type}, held array<boolean>, lens array<int>, codes binary, words binary"))


def places(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The positions of ``keys`` among ``sorted_keys``, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == keys, at, -1)


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different non-negative ``keys`` in order, and the number of each key's among them."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()) >> (63 - bits):
        return np.unique(keys, return_inverse=True)
    # a sort of plain numbers takes a fraction of the time of a sort of positions
    rows = np.sort(keys << bits | np.arange(len(keys)))
    at, rows = rows & (1 << bits) - 1, rows >> bits
    new = np.diff(rows, prepend=-1) != 0
    number = np.empty(len(keys), np.int64)
    number[at] = np.cumsum(new) - 1
    return rows[new], number


class Level:
    """The contexts of one length in a batch and their (context, next word) pairs.

    ``node`` is the number of the context before each token, or -1; a pair is a number of the context
    times the vocabulary plus the word's code."""

    def __init__(self, node: np.ndarray, ids: np.ndarray, total: np.ndarray, batch: "Batch"):
        self.node, self.ids, self.total = node.astype(np.int32), ids, total
        on = self.on = np.flatnonzero(node >= 0).astype(np.int32)
        self.pairs, pair_at = numbered(node[on].astype(np.int64) * batch.size + batch.codes[on])
        self.n = np.bincount(pair_at[batch.train[on]], minlength=len(self.pairs)).astype(np.int64)
        self.c, self.pair_ids = self.n.copy(), np.full(len(self.pairs), -1, np.int64)
        self.pair = np.full(len(node), -1, np.int32)         # of each token
        self.pair[on] = pair_at

    def answered(self, blobs: list[bytes], batch: "Batch") -> None:
        """Take in the corpus counts (and ids) of pairs that other batches hold as well."""
        order = np.argsort(self.ids)                         # once for the blobs of all partitions
        sorted_ids = self.ids[order]
        for blob in blobs:
            prefix, word, c, ids = unpacked_run(blob, 4)
            node = order[np.searchsorted(sorted_ids, prefix)]
            code = batch.by_id[np.searchsorted(batch.sorted_words, word)]
            at = np.searchsorted(self.pairs, node * batch.size + code)       # node: 64-bit
            self.c[at], self.pair_ids[at] = c, ids


class Batch:
    def __init__(self, row: dict, told: pa.Table, depth: int, least: float, n_tokens: int):
        self.codes = unpacked(row["codes"])
        self.lens, held = np.array(row["lens"], np.int64), np.array(row["held"], bool)
        self.train = np.repeat(~held, self.lens)
        self.word_ids, self.word_c = unpacked_run(row["words"], 2)
        self.size, self.by_id = len(self.word_ids), np.argsort(self.word_ids)
        self.sorted_words = self.word_ids[self.by_id]
        level_of = told.column("level").to_numpy()
        blobs, is_answer = told.column("blob"), told.column("kinds").is_null().to_numpy()
        often = np.flatnonzero((self.word_c >= least) & (np.arange(self.size) > 0))
        rank = np.full(self.size, -1, np.int32)
        rank[often] = np.arange(len(often))
        node = np.concatenate([np.array([-1], np.int32), rank[self.codes[:-1]]])
        self.levels = [Level(node, self.word_ids[often], self.word_c[often], self)]
        for k in range(1, depth + 1):
            last = self.levels[-1]
            last.answered([b.as_py() for b in blobs.filter(pa.array((level_of == k) & is_answer)) if b.is_valid], self)
            if k < depth:
                # a context that is one word longer is a pair that is seen often enough
                longer = np.flatnonzero((last.c >= least) & (last.pairs % self.size > 0) & (last.pair_ids >= 0))
                rank = np.full(len(last.pairs) + 1, -1, np.int32)
                rank[longer] = np.arange(len(longer))
                node = np.concatenate([np.array([-1], np.int32), rank[last.pair[:-1]]])
                self.levels.append(Level(node, last.pair_ids[longer], last.c[longer], self))
        self.n_tokens = n_tokens

    def run_columns(self) -> list[np.ndarray]:
        """Of the pairs of the greatest length: context, word, own count, the count of the suffix's pair, and
        the totals of the context and its suffix."""
        top = self.levels[-1]
        first = np.zeros(len(top.pairs), np.int64)
        first[top.pair[top.on]] = top.on                # some token of each pair
        node, code = top.pairs // self.size, top.pairs % self.size
        if len(self.levels) == 1:
            up_c, up_total = self.word_c[code], np.full(len(code), self.n_tokens, np.int64)
        else:
            up = self.levels[-2]
            up_c, up_total = up.c[up.pair[first]], up.total[up.node[first]]
        return [top.ids[node], self.word_ids[code], top.n, up_c, top.total[node], up_total]


    def order(self, part: np.ndarray, parts: int) -> np.ndarray:
        """The pairs of the greatest length by part, context and word."""
        top = self.levels[-1]
        node, code = top.pairs // self.size, top.pairs % self.size
        if parts * len(top.ids) * self.size >> 63:
            return np.lexsort((self.word_ids[code], top.ids[node], part))
        rank, by_word = np.empty(len(top.ids), np.int64), np.empty(self.size, np.int64)
        rank[np.argsort(top.ids)] = np.arange(len(top.ids))
        by_word[self.by_id] = np.arange(self.size)
        return np.argsort((part * len(top.ids) + rank[node]) * self.size + by_word[code])


def context_runs(batches: DataFrame, told: DataFrame, depth: int, least: float, n_tokens: int, parts: int) -> DataFrame:
    """Sorted runs (part, batch, contexts, blob) of the next words of the candidate contexts of length ``depth``;
    ``contexts`` are those that several partitions share."""
    hot = max(n_tokens // parts, 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"part": [], "batch": [], "contexts": [], "blob": []}
        for row in left.to_pylist():
            b = Batch(row, right, depth, least, n_tokens)
            cols = b.run_columns()
            prefix, word, total = cols[0], cols[1], cols[4]
            part = mixed(np.where(total >= hot, prefix * 1_000_003 + word, prefix), parts)
            order = b.order(part, parts)
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
            for a, z in zip(cuts, np.append(cuts[1:], len(order))):
                rows = order[a:z]
                out["part"].append(int(part[rows[0]]))
                out["batch"].append(row["batch"])
                out["contexts"].append(np.unique(prefix[rows][total[rows] >= hot]))
                out["blob"].append(packed_run(*(c[rows] for c in cols)))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})

    of = told.withColumnRenamed("batch", "of")
    return (batches.select("batch", "held", "lens", "codes", "words").groupBy("batch").cogroup(of.groupBy("of"))
            .applyInArrow(run, "part long, batch long, contexts array<long>, blob binary"))


def passes(deviance, cells):
    """The divergence test."""
    return (cells > 0) & (deviance > cells + DEVIATIONS * np.sqrt(2 * cells))


def merged_runs(runs: DataFrame, least: float, hot: int) -> DataFrame:
    """Rows (context, deviance, cells, total, kept, kinds): what a partition finds of a context that it shares; rows
    (batch, kinds 0, blob of context, total, kept, kinds): the states among its own contexts, told to the
    batches that hold them; and rows (batch, blob of context, word, count, id): the answers to the batches.  A batch gets what it can't know: counts of
    pairs that others hold too, and ids (-1: none) of pairs that are candidates of the next length."""
    def run(key: tuple, group: pa.Table) -> pa.Table:
        part, read = key[0].as_py(), [unpacked_run(b.as_py(), 6) for b in group.column("blob")]
        prefix, word, n, up_c, total, up_total = np.concatenate(read, axis=1)
        batch = np.repeat(group.column("batch").to_numpy(), [r.shape[1] for r in read])
        order = np.lexsort((word, prefix))                  # along the sorted runs
        starts = np.flatnonzero((np.diff(prefix[order], prepend=prefix[order[0]] - 1) != 0)
                                | (np.diff(word[order], prepend=word[order[0]] - 1) != 0))
        c, holders = np.add.reduceat(n[order], starts), np.diff(starts, append=len(order))
        one = order[starts]
        seen = np.flatnonzero(c > 0)
        out = []
        if len(seen):
            k, expected = c[seen], total[one[seen]] * (up_c[one[seen]] / up_total[one[seen]])
            cell = np.maximum(k, expected) >= MIN_CELL
            kept = np.where(k >= MIN_NEXT, k, 0)
            at = np.flatnonzero(np.diff(prefix[one[seen]], prepend=prefix[one[seen[0]]] - 1))
            gain = np.where(cell, 2 * (k * np.log(k / expected) - (k - expected)), 0.0)
            add = lambda x: np.add.reduceat(x, at)
            cols = {"context": prefix[one[seen[at]]], "total": total[one[seen[at]]], "deviance": add(gain),
                    "cells": add(cell.astype(np.int64)), "kept": add(kept), "kinds": add((kept > 0).astype(np.int64))}
            split = cols["total"] >= hot
            out.append(_told(int(split.sum()), **{k: v[split] for k, v in cols.items()}))
            good = ~split & passes(cols["deviance"], cols["cells"])
            told_states = [cols[k][good] for k in ("context", "total", "kept", "kinds")]
            at = places(told_states[0], prefix)
            names, rank = np.unique(batch, return_inverse=True)
            holds = np.unique(rank[at >= 0] * max(len(told_states[0]), 1) + at[at >= 0])
            if len(holds):
                of, state = holds // len(told_states[0]), holds % len(told_states[0])
                cuts = np.flatnonzero(np.diff(of, prepend=-1))
                blobs = [packed_run(*(c[state[a:b]] for c in told_states)) for a, b in zip(cuts, np.append(cuts[1:], len(of)))]
                out.append(_told(len(blobs), batch=names[of[cuts]], blob=blobs, kinds=np.zeros(len(blobs), np.int64)))
        told = (holders > 1) & (c > 0) | (c >= least)
        if told.any():
            ids = np.where(c >= least, (part << 32) + np.arange(len(c)), -1)
            of = np.repeat(np.arange(len(c)), holders)
            sel = np.flatnonzero(told[of])
            by_batch = sel[np.argsort(batch[order][sel], kind="stable")]
            holder = batch[order][by_batch]
            cuts = np.flatnonzero(np.diff(holder, prepend=holder[0] - 1))
            blobs = []
            for a, b in zip(cuts, np.append(cuts[1:], len(by_batch))):
                g = of[by_batch[a:b]]
                blobs.append(packed_run(prefix[one[g]], word[one[g]], c[g], ids[g]))
            out.append(_told(len(blobs), batch=holder[cuts], blob=blobs))
        return pa.concat_tables(out) if out else _told(0)

    return runs.select("part", "batch", "blob").groupBy("part").applyInArrow(run, ", ".join(
        f"{n} {t}" for n, t in TOLD))


TOLD = (("batch", "long"), ("blob", "binary"), ("context", "long"), ("total", "long"), ("deviance", "double"),
        ("cells", "long"), ("kept", "long"), ("kinds", "long"))
STATE = ("level", "context", "total", "kept", "kinds")
ARROW = {"long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}


def _told(n: int, **cols) -> pa.Table:
    return pa.table({c: pa.array(cols[c], ARROW[t]) if c in cols else pa.nulls(n, ARROW[t]) for c, t in TOLD})


def states_of(found: DataFrame) -> DataFrame:
    """(context, total, kept, kinds) of the shared contexts that pass the divergence test: the training tokens that
    follow, of them those whose word is seen MIN_NEXT times there, and how many such words there are."""
    all_parts = found.filter("context IS NOT NULL").groupBy("context").agg(
        F.sum("deviance").alias("deviance"), F.sum("cells").alias("cells"), F.first("total").alias("total"),
        F.sum("kept").alias("kept"), F.sum("kinds").alias("kinds"))
    diverges = (F.col("cells") > 0) & (F.col("deviance") > F.col("cells") + DEVIATIONS * F.sqrt(2 * F.col("cells")))
    return all_parts.filter(diverges).select("context", "total", "kept", "kinds")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_share: float = MIN_SHARE,
          batch_tokens: int = BATCH_TOKENS, min_support: int = MIN_SUPPORT, max_depth: int = MAX_DEPTH,
          least_parts: int = LEAST_PARTS) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    batches = materialize(batches_of(docs, id_col, text_col, batch_tokens))
    rows = (batches.select("batch", F.posexplode(F.arrays_zip("vocab", "counts")).alias("code", "w"))
            .select("batch", "code", F.col("w.vocab").alias("word"), F.col("w.counts").alias("n")))
    words, seen = materialize_observed(
        rows.groupBy("word").agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("holders"))
        .withColumn("id", F.monotonically_increasing_id()),
        F.sum("c").alias("tokens"), F.count_if(F.col("c") > 0).alias("words"))
    n_tokens, n_words = seen["tokens"] or 0, seen["words"] or 0
    least = max(min(min_share * n_tokens, min_support), 1)
    parts = least_parts + n_tokens // PART_TOKENS
    several = words.filter("holders > 1").select("word", "id", "c")
    told = rows.select(F.col("batch").alias("of"), "code", "word").join(several, "word").select("of", "code", "id", "c")
    texts, batches = batches, materialize(with_words(batches, told))
    discard(texts, words)
    nothing = batches.sparkSession.createDataFrame(
        [], "batch long, level int, blob binary, context long, total long, kept long, kinds long")
    told = nothing
    for depth in range(1, max_depth + 1):
        runs = materialize(context_runs(batches, told, depth, least, n_tokens, parts))
        found = materialize(merged_runs(runs, least, max(n_tokens // parts, 1)))
        answers = found.filter("batch IS NOT NULL").select("batch", F.lit(depth).alias("level"), "blob", "context", "total",
                                                           "kept", "kinds")
        holders = runs.select("batch", F.explode("contexts").alias("context")).distinct()
        states = holders.join(states_of(found), "context").select(
            "batch", F.lit(depth).alias("level"), F.lit(None).cast("binary").alias("blob"), "context", "total", "kept", "kinds")
        told = told.unionByName(answers).unionByName(materialize(states))
        discard(runs)
    return _scored(batches, told, max_depth, least, n_tokens, n_words)


def _scored(batches: DataFrame, told: DataFrame, depth: int, least: float, n_tokens: int, n_words: int) -> DataFrame:
    id_type = batches.schema["ids"].dataType.elementType.simpleString()

    def scores(b: Batch, right: pa.Table) -> tuple:
        """(base, score) as log10, and whether the word is known, by token."""
        shared = right.filter(pc.is_null(right.column("blob")))
        parts = [np.stack([shared.column(c).to_numpy().astype(np.int64) for c in STATE])]
        for level, blob in zip(right.column("level").to_pylist(), right.column("blob").to_pylist()):
            if blob is not None:
                rows = unpacked_run(blob, 4)
                parts.append(np.concatenate([np.full((1, rows.shape[1]), level), rows]))
        level_of, context, total, kept, kinds = np.concatenate(parts, axis=1)
        p = (b.word_c[b.codes] + 1) / (n_tokens + n_words + 1)
        base = np.log10(p)
        for k, level in enumerate(b.levels, 1):
            mine = np.flatnonzero(level_of == k)
            ids = context[mine]
            order = np.argsort(ids)
            at = places(ids[order], level.ids)              # the state of each context, or -1
            found = np.where(at >= 0, mine[order][at] if len(mine) else -1, -1)
            on = level.on[found[level.node[level.on]] >= 0]
            s = found[level.node[on]]
            c = level.c[level.pair[on]]
            own = np.where(c >= MIN_NEXT, c, 0)
            rest = total[s] - kept[s] + kinds[s]
            p[on] = (own + rest * p[on]) / (total[s] + kinds[s])
        return base, np.log10(p), b.word_c[b.codes] > 0

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        is_state = pc.is_valid(right.column("kinds"))
        blobs, states = right.filter(pc.invert(is_state)), right.filter(is_state)
        for row in left.to_batches():
            for i in range(row.num_rows):
                r = {k: row.column(k)[i].as_py() for k in row.schema.names if k != "ids"}
                b = Batch(r, blobs, depth, least, n_tokens)
                base, full, known = scores(b, states)
                lens, held = b.lens, pa.array(r["held"], pa.bool_())
                of = np.repeat(np.arange(len(lens)), lens)
                out.append(pa.Table.from_arrays(
                    [row.column("ids")[i].values, held, pa.array(lens),
                     pa.array(np.bincount(of, weights=known, minlength=len(lens)).astype(np.int64)),
                     pa.array(np.full(len(lens), n_tokens)),
                     pa.array(np.bincount(of, weights=base, minlength=len(lens))),
                     pa.array(np.bincount(of, weights=full, minlength=len(lens)))],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out)

    schema = (f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    of = told.withColumnRenamed("batch", "of")
    return batches.groupBy("batch").cogroup(of.groupBy("of")).applyInArrow(run, schema)


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs).withColumnRenamed("id", "doc_id")
