"""Line dedup by a segment-partition edit join.

Two lines are linked when their edit distance (code points) is at most ``edits_allowed`` of the
longer one: MAX_EDITS, and never more than a fifth of its length (similarity 0.8 or more).  Lines
linked directly or over others are one class; its first occurrence stays.

A line of length l is cut into t+1 even segments, t being the edits allowed.  Of two linked
lines at least one segment of the shorter one stands unchanged in the longer one, and only in
a few places (shifted by no more than the edits to its left and to its right), so a line is entered
under the hash of (t, l, segment number, segment) and probes those substrings of its own for every
length down to l - t.  Rows are (hash, line id); runs of equal hashes that hold a single line,
nearly all of them, end there, however often that line is entered.  For the others the texts are
fetched once.  A run of few lines is searched breadth-first; a longer one is divided first: what
all its lines begin and end with is taken off, the rest is cut into PIECES, and two linked lines
agree in all pieces but two, so lines meet under the hashes of such choices.  A pair that a
comparison of slices doesn't turn away is verified with a banded bit-parallel edit distance: one bit
a diagonal, one word for each number of errors.  A run of k lines gives at most k-1 edges.  A run
beyond HOT_RUN lines is dealt out in pairs of blocks, each a run of its own.  Components are found
on the distributed edges.

Equal lines are one line (id: XXH64 shortened to 63 bits).  Defined results: blank lines and NULL
texts have no lines to compare; lines below five characters are only equal or different; a NULL
document id comes last in the order of occurrences; repeated rows repeat their lines; an empty
table gives an empty result; extra columns are ignored (``line_classes``) or carried
(``drop_repeated_lines``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.components import components
from tallyspark.llm.text import BLANKS, NOT_BLANK, as_they_are, columns_free_of
from tallyspark.operators.materialize import materialize, materialize_observed

MAX_EDITS = 2
LENGTH_PER_EDIT = 5
HOT_RUN = 1024
FEW_LINES = 16          # lines that are searched without being divided
PIECES = 8
SALTS = 16
LINE_SEED = 42          # of Spark's xxhash64


def edits_allowed(length: int) -> int:
    return min(MAX_EDITS, length // LENGTH_PER_EDIT)


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of edits+1 even segments, the longer ones last."""
    size, longer = divmod(length, edits + 1)
    out, at = [], 0
    for i in range(edits + 1):
        n = size + (i >= edits + 1 - longer)
        out.append((at, n))
        at += n
    return out


@lru_cache(maxsize=100_000)
def lookups(length: int) -> tuple[tuple[int, int, int, int], ...]:
    """(start, end, seed, role) of the substrings a line of this length is found by.  Role 1: a
    segment of the line itself, which also probes the lines of its own length; 0: a probe only."""
    out = []
    for edits in {edits_allowed(longer) for longer in range(length, length + MAX_EDITS + 1)
                  if longer - length <= edits_allowed(longer)} - {0}:
        for i, (at, n) in enumerate(segments(length, edits)):
            out.append((at, at + n, _seed(edits, length, i), 1))
    edits = edits_allowed(length)
    for shift in range(edits + 1 if edits else 0):
        shorter = length - shift
        for i, (at, n) in enumerate(segments(shorter, edits)):
            low = max(0, at - i, at + shift - (edits - i))
            high = min(length - n, at + i, at + shift + (edits - i))
            out += [(p, p + n, _seed(edits, shorter, i), 0) for p in range(low, high + 1)
                    if shift or p != at]
    return tuple(out)


def _seed(edits: int, length: int, segment: int) -> int:
    return (length << 8) | (edits << 4) | segment


# --- banded bit-parallel edit distance ---------------------------------------------------------

BAND = 2 * MAX_EDITS + 1
FULL = (1 << BAND) - 1


def shared_start(x: str, y: str) -> int:
    """Length of the common start, found by halving."""
    low, high = 0, min(len(x), len(y))
    while low < high:
        middle = (low + high + 1) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


OPERATIONS = ((1, 1), (1, 0), (0, 1))     # characters of x and of y that an edit takes


def equal_between(x: str, y: str, edits: int) -> bool:
    """Can these cores, which differ at both ends, be ``edits`` (one or two) edits apart?  One edit
    stands at either end then, and what lies between is equal: a few comparisons of slices,
    which turn nearly all candidates away."""
    for a, b in OPERATIONS:
        if x[a:] == y[b:]:
            return True
    if edits == 1:
        return False
    m, n = len(x), len(y)
    for a, b in OPERATIONS:
        for c, d in OPERATIONS:
            if m - a - c == n - b - d >= 0 and x[a:m - c] == y[b:n - d]:
                return True
    return False


def within(x: str, y: str) -> bool:
    """Are the lines linked?  Bit d of ``rows[e]``: the part of x read so far and a part of y
    that is d - MAX_EDITS longer are at most e edits apart."""
    edits = edits_allowed(max(len(x), len(y)))
    if abs(len(x) - len(y)) > edits:
        return False
    if x == y or not edits:
        return x == y
    start = shared_start(x, y)
    end = shared_start(x[start:][::-1], y[start:][::-1])
    x, y = x[start:len(x) - end], y[start:len(y) - end]
    if not equal_between(x, y, edits):
        return False
    rows = tuple(((2 << e) - 1) << MAX_EDITS for e in range(edits + 1))
    beside = OUTSIDE * MAX_EDITS + y + OUTSIDE * (len(x) + MAX_EDITS)
    for same in zip(*(map(eq, x, beside[d:]) for d in range(BAND))):
        rows = step(rows, same)
        if not rows[edits]:
            return False
    return bool(rows[edits] >> (len(y) - len(x) + MAX_EDITS) & 1)


OUTSIDE = "\ud800"      # a character that no text holds


@lru_cache(maxsize=100_000)
def step(rows: tuple[int, ...], equal: tuple[bool, ...]) -> tuple[int, ...]:
    """``rows`` after one more character of x; ``equal``: is it that of y on each diagonal?"""
    same = sum(1 << d for d, it_is in enumerate(equal) if it_is)
    below = new = rows[0] & same
    out = [new & FULL]
    for last, row in zip(rows, rows[1:]):
        new = (row & same | last | last >> 1 | below << 1) & FULL
        out.append(new)
        below = new
    return tuple(out)


# --- search of a run ---------------------------------------------------------------------------

# how far the pieces of a line stand behind those of one that is ``shift`` shorter
SHIFTS = [(0, -1), (0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (2, 1), (2, 2)]
FIRST, SECOND = np.array(list(combinations(range(PIECES), 2))).T
APART = SECOND - FIRST > 1
WEIGHTS = np.array([xxhash.xxh64_intdigest(b"", i) | 1 for i in range(PIECES + 2)], np.uint64)


@lru_cache(maxsize=100_000)
def pieces(length: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a text of this length, some of them empty if it is short."""
    return [(at, at + n) for at, n in segments(length, PIECES - 1)]


def meetings(texts: list[str]) -> Iterator[list[int]]:
    """Groups (positions, two or more) of which at least one holds any two texts that are at most two
    edits apart.  The edits lie in at most two pieces of the shorter text; the pieces before the first of
    these stand in the longer text where they were, those behind the second are shifted by the
    difference in length, and those between, if both are edited and so once each, by one at most."""
    hashes = np.array([[[hash(x[max(0, p + by):max(0, q + by)]) for p, q in pieces(max(0, len(x) - shift))]
                        for shift, by in SHIFTS] for x in texts])
    sums = np.zeros((*hashes.shape[:2], PIECES + 1), np.uint64)
    np.cumsum(hashes.view(np.uint64) * WEIGHTS[:PIECES], axis=2, out=sums[:, :, 1:])
    sums = {at: sums[:, i] for i, at in enumerate(SHIFTS)}
    lengths = np.array([len(x) for x in texts])
    places = (FIRST * PIECES + SECOND).astype(np.uint64) * WEIGHTS[-1]
    keys = []
    for shift, between, which in ((0, 0, APART | True), (0, -1, APART), (0, 1, APART), (1, 0, APART | True),
                                  (1, 1, APART), (2, 1, APART | True)):
        first, second = FIRST[which], SECOND[which]
        start, middle, end = sums[shift, 0], sums[shift, between], sums[shift, shift]
        seeds = (lengths - shift).view(np.uint64) * WEIGHTS[-2]
        keys.append(start[:, first] + middle[:, second] - middle[:, first + 1] + end[:, PIECES:]
                    - end[:, second + 1] + seeds[:, None] + places[which])
    owners = np.concatenate([np.repeat(np.arange(len(texts)) * 2 + (i == 0), k.shape[1])
                             for i, k in enumerate(keys)])
    keys = np.concatenate([k.ravel() for k in keys])
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    ends = np.append(starts[1:], len(keys))
    some = ((owners[starts] >> 1 != owners[ends - 1] >> 1)
            & (np.bitwise_or.reduceat(owners, starts) & 1).astype(bool))
    starts, ends, owners = starts[some], ends[some], owners >> 1
    pairs = ends - starts == 2
    a, b = owners[starts[pairs]], owners[starts[pairs] + 1]
    yield from ([*divmod(x, len(texts))] for x in np.unique(a * len(texts) + b).tolist())
    for p, q in zip(starts[~pairs].tolist(), ends[~pairs].tolist()):
        yield np.unique(owners[p:q]).tolist()


def without_common_ends(texts: list[str]) -> list[str]:
    start = shared_start(min(texts), max(texts))
    texts = [x[start:][::-1] for x in texts]
    end = shared_start(min(texts), max(texts))
    return [x[end:][::-1] for x in texts]


def reached(lines: list[str]) -> list[tuple[int, int]]:
    """Edges (positions) of a forest over the linked lines."""
    if len(lines) == 2:
        return [(0, 1)] if within(*lines) else []
    up, edges, tried = list(range(len(lines))), [], set()

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def met(x: int, y: int) -> bool:
        """Are the lines in one tree, as they were or by a new edge?"""
        a, b = root(x), root(y)
        if a == b:
            return True
        pair = x * len(lines) + y if x < y else y * len(lines) + x
        if pair in tried:
            return False
        if not within(lines[x], lines[y]):
            tried.add(pair)
            return False
        up[b] = a
        edges.append((x, y))
        return True

    def search(left: Iterable[int]) -> None:
        left = list(left)
        while left:
            queue, left = [left[0]], left[1:]
            while queue and left:
                x = queue.pop()
                new = [y for y in left if met(x, y)]
                queue += new
                gone = set(new)
                left = [y for y in left if y not in gone] if gone else left

    groups: list[tuple[Iterable[int], int | None]] = [(range(len(lines)), None)]
    divided = set()
    while groups:
        group, longest = groups.pop()
        if len({root(x) for x in group}) == 1 < len(group):
            continue
        if len(group) <= FEW_LINES:
            search(group)
            continue
        texts = without_common_ends([lines[x] for x in group])
        most = max(map(len, texts))
        # a group whose lines still differ all over is not divided again
        if longest is not None and 2 * most > longest:
            search(group)
            continue
        parts = set()
        for at in meetings(texts):
            part = tuple(group[i] for i in at)
            if len(part) == 2:
                met(*part)
            else:
                parts.add(part)
        # the smallest first: of larger ones little is left to link then
        groups += [(x, most) for x in sorted(parts - divided, key=lambda x: (-len(x), x))]
        divided |= parts
    return edges


# --- jobs --------------------------------------------------------------------------------------

def line_id(line: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(line), 1)


def occurrences(docs: DataFrame, text_col: str, *columns: Column) -> DataFrame:
    """One row per line with a word: ``columns``, line_no (from 0), line."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    rows = docs.select(*columns, F.posexplode(lines).alias("line_no", "line"))
    return rows.filter(F.col("line").rlike(NOT_BLANK))


def entries(docs: DataFrame, text_col: str) -> DataFrame:
    """(key, entry): the lookups of every line; entry is twice the line id plus the role."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for b in batches:
            for at in range(0, b.num_rows, 512):
                seen: set[str] = set()
                for text in b.column("text").slice(at, 512).to_pylist():
                    if text:
                        seen.update(text.split("\n"))
                keys, owners = [], []
                for line in seen:
                    if len(line) >= LENGTH_PER_EDIT - 1 and line.strip(BLANKS):
                        found = lookups(len(line))
                        owner = digest(line, LINE_SEED) >> 1 << 1
                        keys += [digest(line[p:q], seed) for p, q, seed, _ in found]
                        owners += [owner | role for *_, role in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (keys, owners)],
                    ["key", "entry"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "key long, entry long")


def shared(rows: DataFrame, most: int) -> DataFrame:
    """(key, line, hot): the distinct lines of each key that at least two lines share, one of
    them by a segment of its own; hot where there are more than ``most``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, entry = np.empty(0, np.int64), np.empty(0, np.uint64)
        split = False           # lines of the key that is held have been handed out
        for b in batches:
            if not b.num_rows:
                continue
            key = np.concatenate([key, b.column("key").to_numpy()])
            entry = np.concatenate([entry, b.column("entry").to_numpy().view(np.uint64)])
            key, entry, out, split = closed(key, entry, split, False)
            if out.num_rows:
                yield out
        yield closed(key, entry, split, True)[2]

    def closed(key: np.ndarray, entry: np.ndarray, split: bool, end: bool):
        """What has to be held of the sorted rows (the last key's), the lines handed out, and whether
        the key that is held has had lines among them."""
        other = key[1:] != key[:-1]
        new = np.ones(len(key), bool)       # equal entries count once
        new[1:] = other | (entry[1:] != entry[:-1])
        first = np.ones(len(key), bool)     # of the two roles of a line
        first[1:] = other | (entry[1:] >> np.uint64(1) != entry[:-1] >> np.uint64(1))
        starts = np.flatnonzero(np.concatenate([[True], other])[:len(key)])
        sizes = np.diff(np.append(starts, len(key)))
        lines = np.add.reduceat(first, starts, dtype=np.int64) if len(starts) else starts
        own = (np.bitwise_or.reduceat(entry, starts) & np.uint64(1)).astype(bool) if len(starts) else starts > 0
        hot = lines > most
        some = hot | (lines > 1) & own
        held = slice(len(key), None)
        if len(starts):
            if split:
                hot[0] = some[0] = True
            if not end:
                held = slice(starts[-1], None)
                some[-1] &= hot[-1]
                split = bool(some[-1])
        out = first & np.repeat(some, sizes)
        rows = pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (key[out], (entry[out] >> np.uint64(1)).view(np.int64), np.repeat(hot, sizes)[out])],
            ["key", "line", "hot"])
        key, entry = key[held][new[held]], entry[held][new[held]]
        return (key[-1:], entry[-1:], rows, True) if split and len(key) else (key, entry, rows, False)

    rows = rows.repartition("key").sortWithinPartitions("key", "entry")
    return rows.mapInArrow(run, "key long, line long, hot boolean")


def searched(rows: DataFrame, *key: str) -> DataFrame:
    """Edges (u, v) found among the rows (key, line, text) of each key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v, held = [], [], None
        for b in batches:
            table = pa.Table.from_batches([b])
            table = table if held is None else pa.concat_tables([held, table])
            differs = np.zeros(max(0, table.num_rows - 1), bool)
            for k in key:
                col = table.column(k).to_numpy()
                differs |= col[1:] != col[:-1]
            last = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
            search(table.slice(0, last), differs, u, v)
            held = table.slice(last)
            if len(u) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (u, v)], ["u", "v"])
                u, v = [], []
        if held is not None:
            search(held, np.zeros(held.num_rows, bool), u, v)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (u, v)], ["u", "v"])

    def search(table: pa.Table, differs: np.ndarray, u: list[int], v: list[int]) -> None:
        ids, lines = table.column("line").to_pylist(), table.column("text").to_pylist()
        cuts = [0, *(np.flatnonzero(differs[:max(0, len(ids) - 1)]) + 1).tolist(), len(ids)]
        for p, q in zip(cuts, cuts[1:]):
            for a, b in reached(lines[p:q]) if q - p > 1 else ():
                u.append(ids[p + a])
                v.append(ids[p + b])

    # a run of a few MB takes long, so the number of tasks is given: it isn't lowered by the bytes
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(*key, "line", "text").repartition(tasks, *key).sortWithinPartitions(*key, "line")
    return rows.mapInArrow(run, "u long, v long")


def links(docs: DataFrame, text_col: str, hot_run: int = HOT_RUN) -> DataFrame:
    """Edges that connect exactly the linked lines."""
    found, seen = materialize_observed(shared(entries(docs, text_col), hot_run),
                                       F.sum(F.col("hot").cast("long")).alias("hot"))
    # a line that a third of all documents hold is fetched by SALTS keys, each collapsed on its own
    # before the texts meet by line; a sort-merge at every size
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("wanted_salt")
    wanted = found.select(F.col("line").alias("wanted")).distinct().select("wanted", salts).hint("merge")
    lines = occurrences(docs, text_col).select(
        line_id("line").alias("line"), F.col("line").alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"))
    texts = materialize(lines.join(wanted, (lines["line"] == wanted["wanted"])
                                   & (lines["salt"] == wanted["wanted_salt"]), "left_semi")
                        .dropDuplicates(["line"]).select("line", "text"))
    edges = searched(found.filter(~F.col("hot")).join(texts, "line"), "key")
    if seen["hot"]:
        hot = found.filter("hot").select("key", "line").distinct()
        blocks = hot.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / hot_run).alias("blocks"))
        own = F.pmod(F.xxhash64("line"), F.col("blocks"))
        pairs = (hot.join(blocks, "key").withColumn("own", own)
                 .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
                 .select("key", "line", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")))
        edges = edges.unionByName(searched(pairs.join(texts, "line"), "key", "a", "b"))
    return edges


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 hot_run: int = HOT_RUN) -> DataFrame:
    """One row per line with a word: id, line_no, first_id, first_line_no (the first occurrence of
    its class), class_lines (occurrences), kept."""
    roots = components(links(docs, text_col, hot_run))
    rows = occurrences(docs, text_col, F.col(id_col).alias("id")).select("id", "line_no", line_id("line").alias("line"))
    r = roots.select(F.col("node").alias("line"), "root")
    rows = materialize(rows.join(r, "line", "left")
                       .select("id", "line_no", F.coalesce("root", "line").alias("class")))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("line_no")))
    # written, so that the join below is one of two plain exchanges too
    classes = materialize(rows.groupBy("class").agg(first.alias("first"),
                                                    F.count(F.lit(1)).alias("class_lines")))
    return rows.join(classes, "class").select(
        "id", "line_no", F.col("first.id").alias("first_id"), F.col("first.line_no").alias("first_line_no"),
        "class_lines", (F.col("id").eqNullSafe(F.col("first.id"))
                        & (F.col("line_no") == F.col("first.line_no"))).alias("kept"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every line taken out of the text that isn't the first of its class.  Ids have to be
    unique."""
    n = columns_free_of(docs.columns, "gone", "gone_id")
    gone = (line_classes(docs, id_col, text_col).filter(~F.col("kept")).groupBy("id")
            .agg(F.collect_set("line_no").alias(n["gone"])).withColumnRenamed("id", n["gone_id"]))
    rows = docs.join(gone, F.col(id_col).eqNullSafe(F.col(n["gone_id"])), "left")
    left = F.filter(F.split(text_col, "\n", -1), lambda line, i: ~F.array_contains(n["gone"], i))
    text = F.when(F.col(n["gone"]).isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    return rows.withColumn(text_col, text).select(*as_they_are(docs.columns))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_classes(docs).select(F.col("id").alias("doc_id"), "line_no",
                                     F.col("first_id").alias("first_doc_id"), "first_line_no",
                                     "class_lines", "kept")
