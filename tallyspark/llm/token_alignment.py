"""Cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizers A and B cut the same bytes (a blank and the text).  Offsets where tokens of both
end cut the tokens into groups; an A and a B token are linked where their byte ranges overlap.

1. A task lays its documents into blocks of about BLOCK_LINKS links.  In a block every pair of
   an A id and a B id has an inverted posting: compressed bitmaps over the block's documents, one for
   each binary digit of how often the document links the pair (multiplicity planes).  A plane is
   a sorted list of document numbers or a bit set, whichever is shorter.  OR-ing the planes
   gives the documents that hold the pair; popcounts give their number and, weighted by the
   planes' digits, the number of links.
2. The (block, pair) counts are summed over the corpus, and the highest count of each B id is
   found.  Blocks hold different documents, so the OR over blocks is their concatenation and
   its popcount the sum.
3. The scores go back to the blocks that hold the pair, and their postings return them to the
   documents.

Words between lone blanks are encoded and aligned once a block (no piece of B holds a blank after
another character, which is checked when the model is loaded, and no piece of A spans a lone
blank); other texts are encoded whole.

Defined results: a text that is NULL or empty, or whose tokens' bytes aren't the blank and the text,
has no tokens (zeros, groups and their digest ''); special strings inside texts are ordinary text;
repeated rows each count and each give a row; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.bpe_words import ByteBpe
from tallyspark.operators.materialize import materialize

BLOCK_LINKS = 3 << 20        # links after which a block is closed
BLOCK_DOCS = 1 << 16         # document numbers of a block fit two bytes
BLOCK_WORDS = 1 << 19        # different words after which a block is closed
BLOCK_BYTES = 1 << 25        # bytes of different words after which a block is closed
UNITS = 1 << 14              # units that are encoded at a time
MOST_TEXTS = 256             # texts taken out of a batch at a time
DOC_COLUMNS = ("n_a", "n_b", "n_groups")


class Pieces:
    """The sentencepiece model of side B, with the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes, self.by_words = [], True
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.bytes.append(piece.replace("▁", " ").encode())
                self.by_words &= "▁" not in piece.lstrip("▁")


class Aligner:
    """Links and groups of units: a unit is a word or a whole text, with a blank before it."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteBpe(path_a, special=False), Pieces(path_b)
        self.a_bytes = self.a.token_bytes()
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b.bytes], np.int64)

    def units_of(self, text: str) -> list[str]:
        """The words of a text, or the text itself behind a blank (a word never begins with one)."""
        if not text:
            return []
        return text.split(" ") if self.b.by_words and self.a.wordwise(text) else [" " + text]

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """(A ids, B ids) of each unit."""
        a: list = [None] * len(units)
        words = [i for i, u in enumerate(units) if u[0] != " "]
        ids, at = self.a.words([units[i] for i in words])
        ids, at = ids.tolist(), at.tolist()
        for i, start, end in zip(words, at, at[1:]):
            a[i] = ids[start:end]
        for i, u in enumerate(units):
            if u[0] == " ":
                a[i] = self.a.whole(u).tolist()
        # the model puts the blank before a text itself
        return a, self.b.model.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)

    def aligned(self, units: list[str]) -> "Units":
        out = Units()
        for at in range(0, len(units), UNITS):
            part = units[at:at + UNITS]
            a, b = self.encode(part)
            good = self.good(a, b, part)
            for i in np.flatnonzero(~good):
                a[i] = b[i] = []
            out.add(a, b, good, self.a_len, self.b_len)
        return out.closed()

    def good(self, a: list[list[int]], b: list[list[int]], units: list[str]) -> np.ndarray:
        """Whether the bytes of the tokens are those of the unit, on both sides."""
        want = [(u if u[0] == " " else " " + u).encode() for u in units]
        size = np.array([len(w) for w in want], np.int64)
        sides = ((a, self.a_bytes, self.a_len), (b, self.b.bytes, self.b_len))

        def all_good(side: list[list[int]], known: list[bytes], length: np.ndarray) -> bool:
            ids = list(chain.from_iterable(side))
            ends = np.concatenate([[0], np.cumsum(length[ids])])[np.cumsum([len(x) for x in side])]
            return b"".join([known[i] for i in ids]) == b"".join(want) and (ends == np.cumsum(size)).all()

        if all(all_good(*side) for side in sides):
            return np.ones(len(units), bool)
        return np.array([all(b"".join([known[i] for i in side[k]]) == w for side, known, _ in sides)
                         for k, w in enumerate(want)], bool)


class Units:
    """Aligned units: counts, links (flat, by unit) and the groups as text."""

    def __init__(self):
        none = np.zeros(0, np.int64)
        self.parts = {k: [none] for k in ("n_a", "n_b", "n_groups", "n_links", "pairs")}
        self.parts["good"], self.groups = [none.astype(bool)], []

    def closed(self) -> "Units":
        for name, parts in self.parts.items():
            setattr(self, name, np.concatenate(parts))
        self.first_link = np.cumsum(self.n_links) - self.n_links
        del self.parts
        return self

    def add(self, a: list, b: list, good: np.ndarray, a_len: np.ndarray, b_len: np.ndarray) -> None:
        n = len(a)
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(side), np.int64) for side in (a, b))
        end_a, end_b = np.cumsum(a_len[flat_a]), np.cumsum(b_len[flat_b])
        start_a, start_b = end_a - a_len[flat_a], end_b - b_len[flat_b]
        # links: the B tokens that overlap each A token; the bytes of a unit are the same on both
        # sides, so nothing overlaps beyond it
        low = np.searchsorted(end_b, start_a, side="right")
        counts = np.searchsorted(start_b, end_a, side="left") - low
        link_a = np.repeat(np.arange(len(flat_a)), counts)
        link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        by_a = np.concatenate([[0], np.cumsum(counts)])
        at_a = np.concatenate([[0], np.cumsum(n_a)])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        size_a, size_b = (np.bincount(g, minlength=len(common)) for g in (group_a, group_b))
        first = np.unique(group_a, return_index=True)[1] if len(group_a) else np.zeros(0, np.int64)
        unit_of = np.repeat(np.arange(n), n_a)[first] if len(first) else first
        n_groups = np.bincount(unit_of, minlength=n)
        for name, part in {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": np.diff(by_a[at_a]), "good": good,
                           "pairs": flat_a[link_a] << 32 | flat_b[link_b]}.items():
            self.parts[name].append(part)
        self.groups += self._text(flat_a, flat_b, size_a, size_b, n_groups)

    @staticmethod
    def _text(flat_a, flat_b, size_a, size_b, n_groups) -> list[str]:
        a, b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
        groups, i, j = [], 0, 0
        for k, m in zip(size_a.tolist(), size_b.tolist()):
            if k == m == 1:
                groups.append(a[i] + "|" + b[j])
                i += 1
                j += 1
            else:
                groups.append(",".join(a[i:i + k]) + "|" + ",".join(b[j:j + m]))
                i, j = i + k, j + m
        out, at = [], 0
        for k in n_groups.tolist():
            out.append(";".join(groups[at:at + k]))
            at += k
        return out


@lru_cache(maxsize=1)
def aligner_of(path_a: str, path_b: str) -> Aligner:
    """One a worker process, which runs many tasks."""
    return Aligner(path_a, path_b)


# --- postings: compressed bitmaps with multiplicity planes -----------------------------------

def planes(pair: np.ndarray, doc: np.ndarray, times: np.ndarray, n_docs: int) -> tuple[bytes, bytes]:
    """``pair``, ``doc`` sorted and different as pairs, ``times`` >= 1 -> (heads, data).  A container
    is the bitmap of one pair and digit: head (pair, 2 * plane + is a bit set, documents) as 32-bit
    numbers; data two bytes a document, or a bit for each document of the block."""
    set_bytes = -(-n_docs // 8)
    heads, data = [], []
    for plane in range(int(times.max(initial=0)).bit_length()):
        on = times >> plane & 1 == 1
        p, d = pair[on], doc[on]
        first = np.flatnonzero(np.diff(p, prepend=-1))
        count = np.diff(first, append=len(p))
        dense = 2 * count > set_bytes
        in_set = np.repeat(dense, count)
        for kind, rows in ((0, ~in_set), (1, in_set)):
            chosen = dense if kind else ~dense
            if chosen.any():
                heads.append(np.stack([p[first[chosen]], np.full(chosen.sum(), 2 * plane + kind), count[chosen]], 1))
                if kind:
                    bits = np.zeros((int(chosen.sum()), 8 * set_bytes), bool)
                    bits[np.repeat(np.arange(len(bits)), count[chosen]), d[rows]] = True
                    data.append(np.packbits(bits, axis=1).tobytes())
                else:
                    data.append(d[rows].astype("<u2").tobytes())
    return (np.concatenate(heads).astype("<i4").tobytes() if heads else b""), b"".join(data)


def postings(heads: bytes, data: bytes, n_docs: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(plane, pair of each set bit, document of each set bit), some containers at a time."""
    set_bytes = -(-n_docs // 8)
    heads = np.frombuffer(heads, "<i4").reshape(-1, 3)
    at = 0
    kinds = heads[:, 1]
    cuts = np.flatnonzero(np.diff(kinds, prepend=-1))
    for start, end in zip(cuts, np.append(cuts[1:], len(kinds))):
        pair, plane, dense = heads[start:end, 0], int(kinds[start]) >> 1, int(kinds[start]) & 1
        if dense:
            # a bounded number of bit sets is laid open at a time
            step = max(1, (1 << 24) // max(8 * set_bytes, 1))
            for s in range(0, len(pair), step):
                part = pair[s:s + step]
                size = len(part) * set_bytes
                bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at).reshape(len(part), set_bytes), axis=1)
                row, doc = np.nonzero(bits)
                yield plane, part[row], doc
                at += size
        else:
            count = heads[start:end, 2]
            n = int(count.sum())
            yield plane, np.repeat(pair, count), np.frombuffer(data, "<u2", n, at).astype(np.int64)
            at += 2 * n


class Block:
    """Documents of a task, as numbers into the different units that they consist of."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.units: dict[str, int] = {}
        self.rows, self.codes, self.lens = [], [], []
        self.bytes = self.links = 0

    def add(self, row, text: str) -> None:
        units = self.aligner.units_of(text)
        before = len(self.units)
        code, known = self.units.setdefault, self.units
        self.codes.append(np.array([code(u, len(known)) for u in units], np.int32))
        self.rows.append(row)
        self.lens.append(len(units))
        self.bytes += len(text) if len(self.units) > before else 0
        self.links += len(text) // 3         # about; only the size of a block hangs on it

    def full(self) -> bool:
        return (self.links >= BLOCK_LINKS or len(self.rows) >= BLOCK_DOCS
                or len(self.units) >= BLOCK_WORDS or self.bytes >= BLOCK_BYTES)

    def closed(self) -> dict:
        """The block's columns."""
        keys = list(self.units)
        units = self.aligner.aligned(keys)
        if not units.good.all():
            units = self.aligner.aligned(self._mended(keys, units.good))
        lens, n = np.array(self.lens, np.int64), len(self.rows)
        codes = np.concatenate([*self.codes, np.zeros(0, np.int32)])
        doc_of = np.repeat(np.arange(n), lens)
        out = {c: np.bincount(doc_of, getattr(units, c)[codes], n).astype(np.int64) for c in DOC_COLUMNS}
        shas, at, groups = [], 0, units.groups
        for k in self.lens:
            text = ";".join([groups[c] for c in codes[at:at + k].tolist()])
            shas.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
            at += k
        pairs, pair_of = np.unique(units.pairs, return_inverse=True)
        count = units.n_links[codes]
        first = np.repeat(units.first_link[codes] - (np.cumsum(count) - count), count)
        key = pair_of[first + np.arange(len(first))] * n + np.repeat(doc_of, count)
        key, times = np.unique(key, return_counts=True)
        pair, doc = key // max(n, 1), key % max(n, 1)
        heads, data = planes(pair, doc, times, n)
        return out | {"rows": self.rows, "sha": shas, "pairs": pairs,
                      "docs": np.bincount(pair, minlength=len(pairs)),
                      "links": np.bincount(pair, times, len(pairs)).astype(np.int64),
                      "heads": heads, "data": data}

    def _mended(self, keys: list[str], good: np.ndarray) -> list[str]:
        """Texts with a word whose bytes differ are taken whole: all their tokens count, or none."""
        keys = list(keys)
        for i, codes in enumerate(self.codes):
            if len(codes) and not good[codes].all() and keys[codes[0]][0] != " ":
                text = " " + " ".join([keys[c] for c in codes.tolist()])
                if text not in self.units:
                    self.units[text] = len(keys)
                    keys.append(text)
                self.codes[i], self.lens[i] = np.array([self.units[text]], np.int32), 1
        return keys


def blocks_of(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
              ) -> DataFrame:
    """One row per block: block, ids, n_a, n_b, n_groups, sha (by document), pairs (A id << 32 | B id), docs,
    links (by pair), heads and data (the postings)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = (f"block long, ids array<{id_type}>, n_a array<long>, n_b array<long>, n_groups array<long>, "
              "sha array<string>, pairs array<long>, docs array<long>, links array<long>, heads binary, data binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = aligner_of(path_a, path_b), TaskContext.get().partitionId() << 32
        block, longs, kind = Block(aligner), pa.list_(pa.int64()), None

        def row() -> pa.RecordBatch:
            c = block.closed()
            arrays = [pa.array([number], pa.int64()), pa.array([c["rows"]], pa.list_(kind)),
                      *[pa.array([c[k]], longs) for k in DOC_COLUMNS], pa.array([c["sha"]], pa.list_(pa.string())),
                      *[pa.array([c[k]], longs) for k in ("pairs", "docs", "links")],
                      pa.array([c["heads"]], pa.binary()), pa.array([c["data"]], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["block", "ids", *DOC_COLUMNS, "sha", "pairs", "docs", "links",
                                                       "heads", "data"])

        for b in batches:
            kind = b.schema.field("id").type
            for at in range(0, b.num_rows, MOST_TEXTS):
                part = b.slice(at, MOST_TEXTS)
                for i, text in zip(part.column("id").to_pylist(), part.column("text")):
                    block.add(i, text.as_py())
                    if block.full():
                        yield row()
                        number += 1
                        block = Block(aligner)
        if block.rows:
            yield row()

    return rows.mapInArrow(run, schema)


def pair_rows(blocks: DataFrame) -> DataFrame:
    """(block, at, pair, docs, links): the postings' counts, ``at`` is the pair's number in the block."""
    return (blocks.select("block", F.posexplode(F.arrays_zip("pairs", "docs", "links")).alias("at", "p"))
            .select("block", "at", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"),
                    F.col("p.links").alias("links")))


def pair_scores(rows: DataFrame) -> DataFrame:
    """(pair, a, b, n_docs, n_links, is_best) over the whole corpus: ``is_best`` where no other pair of the
    B id has more links."""
    counts = materialize(rows.groupBy("pair").agg(F.sum("docs").alias("n_docs"), F.sum("links").alias("n_links"))
                         .withColumns({"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(0xFFFFFFFF)}))
    best = counts.groupBy("b").agg(F.max("n_links").alias("most"))
    return counts.join(best, "b").select("pair", "a", "b", "n_docs", "n_links",
                                         (F.col("n_links") == F.col("most")).alias("is_best"))


def document_postings(blocks: DataFrame) -> DataFrame:
    """The inverted index laid open: (a, b, id, times), one row for each document that links the pair."""
    id_type = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, pairs = b.column("ids")[i].values, np.array(b.column("pairs")[i].as_py(), np.int64)
                n = max(len(ids), 1)
                found = [(p * n + d, np.full(len(p), 1 << plane)) for plane, p, d in
                         postings(b.column("heads")[i].as_py(), b.column("data")[i].as_py(), len(ids))]
                if not found:
                    continue
                key, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                times = np.bincount(at, np.concatenate([t for _, t in found])).astype(np.int64)
                pair = pairs[key // n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair >> 32), pa.array(pair & 0xFFFFFFFF), ids.take(pa.array(key % n)), pa.array(times)],
                    ["a", "b", "id", "times"])

    return (blocks.select("ids", "pairs", "heads", "data")
            .mapInArrow(run, f"a long, b long, id {id_type}, times long"))


def scored_documents(blocks: DataFrame, scores: DataFrame) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.  The scores of
    a block's pairs (block, at, n_links, is_best) are returned to its documents by the postings."""
    id_type = blocks.schema["ids"].dataType.elementType.simpleString()
    names = ["id", *DOC_COLUMNS, "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        at, count, best = (right.column(c).to_numpy() for c in ("at", "n_links", "is_best"))
        out = []
        for b in left.to_batches():
            for i in range(b.num_rows):
                ids = b.column("ids")[i].values
                n = len(ids)
                value = np.zeros(len(b.column("pairs")[i]), np.int64)
                value[at] = count
                is_best = np.zeros(len(value), bool)
                is_best[at] = best
                links, hits, total = (np.zeros(n, np.int64) for _ in range(3))
                for plane, pair, doc in postings(b.column("heads")[i].as_py(), b.column("data")[i].as_py(), n):
                    links += np.bincount(doc, minlength=n) << plane
                    hits += np.bincount(doc[is_best[pair]], minlength=n) << plane
                    np.add.at(total, doc, value[pair] << plane)
                out.append(pa.Table.from_arrays(
                    [ids, *[b.column(c)[i].values for c in DOC_COLUMNS], pa.array(links), pa.array(hits),
                     pa.array(total), b.column("sha")[i].values], names))
        return pa.concat_tables(out)

    kept = blocks.select("block", "ids", *DOC_COLUMNS, "sha", "pairs", "heads", "data")
    schema = f"id {id_type}, " + ", ".join(f"{c} long" for c in names[1:-1]) + ", groups_sha256 string"
    told = scores.select(F.col("block").alias("of"), "at", "n_links", "is_best")
    return kept.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(run, schema)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, see ``scored_documents``."""
    blocks = materialize(blocks_of(docs, path_a, path_b, id_col, text_col))
    rows = pair_rows(blocks)
    scores = materialize(pair_scores(rows).select("pair", "n_links", "is_best"))
    told = rows.select("block", "at", "pair").join(scores, "pair").select("block", "at", "n_links", "is_best")
    return scored_documents(blocks, told)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")
