import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import line_dedup as D
from tests.llm.frames import DOCS_SCHEMA, doc_rows, docs_frame


def distance(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def linked(x, y):
    return abs(len(x) - len(y)) <= 2 and distance(x, y) <= D.edits_allowed(max(len(x), len(y)))


def brute(rows):
    """(id, text) -> sorted rows of the result."""
    occ = [(i, n, line) for i, t in rows for n, line in enumerate((t or "").split("\n"))
           if line.strip(D.BLANKS)]
    lines = sorted({o[2] for o in occ})
    up = {x: x for x in lines}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, x in enumerate(lines):
        for y in lines[:a]:
            if linked(x, y):
                up[root(x)] = root(y)
    groups = {}
    for i, n, line in occ:
        groups.setdefault(root(line), []).append((i is None, i, n))
    out = []
    for i, n, line in occ:
        g = groups[root(line)]
        first = min(g, key=lambda o: (o[0], o[1] or 0, o[2]))
        out.append((i, n, first[1], first[2], len(g), (i, n) == first[1:]))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("id", "line_no", "first_id", "first_line_no",
                                                  "class_lines", "kept").collect()), key=str)


def edited(rng, line, edits):
    for _ in range(edits):
        at = rng.randrange(len(line) + 1)
        line = rng.choice([line[:at] + rng.choice("abé ") + line[at:], line[:at] + line[at + 1:],
                           line[:at] + "z" + line[at + 1:]])
    return line


WORD = st.text("abcé ", min_size=0, max_size=18)


@settings(max_examples=300, deadline=None)
@given(WORD, WORD, st.randoms())
def test_distance_is_that_of_the_definition(x, y, rng):
    for other in (y, edited(rng, x, rng.randrange(4))):
        assert D.within(x, other) == linked(x, other)


@settings(max_examples=300, deadline=None)
@given(st.text("abcd", min_size=1, max_size=40), st.randoms())
def test_linked_lines_share_a_lookup(x, rng):
    y = edited(rng, x, rng.randrange(3))
    if x != y and linked(x, y):
        a = {(x[p:q], seed): role for p, q, seed, role in D.lookups(len(x))}
        b = {(y[p:q], seed): role for p, q, seed, role in D.lookups(len(y))}
        assert any(a[k] or b[k] for k in a.keys() & b.keys())


def corpus():
    rng = random.Random(5)
    base = ["".join(rng.choices("abcdefgh ij", k=n)) for n in (4, 5, 6, 9, 10, 11, 14, 30, 60, 120)]
    rows = []
    for i in range(120):
        lines = [edited(rng, rng.choice(base), rng.randrange(5)) for _ in range(4)]
        rows.append((i, "\n".join(lines + ["the banner of all", "", "  "])))
    return rows


def test_classes_match_brute_force(spark):
    rows = corpus() + [r[:2] for r in doc_rows() if len(r[1] or "") < 5000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(D.line_classes(docs)) == brute(rows)


def test_runs_beyond_the_limit_lose_no_link(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(D.line_classes(docs, hot_run=3)) == brute(rows)


def test_long_runs():
    rng = random.Random(2)
    lines = sorted({edited(rng, "common start and a common end", rng.randrange(6)) for _ in range(80)})
    up = list(range(len(lines)))
    for a, b in D.reached(lines):
        assert linked(lines[a], lines[b])
        up = [up[b] if u == up[a] else u for u in up]
    for a, x in enumerate(lines):
        for b in range(a):
            if linked(x, lines[b]):
                assert up[a] == up[b]


def trees(n, edges):
    up = list(range(n))
    for a, b in edges:
        up = [up[a] if u == up[b] else u for u in up]
    return [up.index(u) for u in up]


def test_divided_runs_lose_no_link():
    rng = random.Random(4)
    for alphabet, length, edits in (("ab", 9, 3), ("ab", 30, 6), ("abcdefgh é", 60, 5), ("abcdefgh é", 3, 2)):
        base = ["".join(rng.choices(alphabet, k=length)) for _ in range(3)]
        lines = sorted({edited(rng, rng.choice(base), rng.randrange(edits + 1)) for _ in range(120)})
        edges = D.reached(lines)
        assert all(linked(lines[a], lines[b]) for a, b in edges)
        pairs = [(a, b) for a, x in enumerate(lines) for b in range(a) if linked(x, lines[b])]
        assert trees(len(lines), edges) == trees(len(lines), pairs)


def test_runs_are_not_compared_pair_by_pair(monkeypatch):
    calls = []
    within = D.within
    monkeypatch.setattr(D, "within", lambda x, y: calls.append(1) or within(x, y))
    rng = random.Random(6)
    lines = sorted({f"order {rng.randrange(10 ** 9):09d} was shipped from the warehouse" for _ in range(600)})
    D.reached(lines)
    base = "".join(rng.choices("abcdefgh ij", k=300))
    lines = sorted({base[:100] + edited(rng, base[100:], 12) for _ in range(600)})
    D.reached(lines)
    assert len(calls) < 20_000          # of 360,000 pairs


def test_a_line_entered_often_shares_its_keys_with_no_other(spark):
    rows = [(key, 2 * 5 + 1) for key in range(20) for _ in range(50)] + [(99, 2 * x + 1) for x in (7, 7, 8, 9, 9, 9)]
    frame = spark.createDataFrame(rows, "key long, entry long")
    for most, hot in ((2, True), (3, False)):
        out = D.shared(frame, most).distinct().collect()
        assert sorted(tuple(r) for r in out) == [(99, x, hot) for x in (7, 8, 9)]


def test_few_bytes_of_hot_runs_are_searched_by_many_tasks(spark):
    rows = spark.range(64).selectExpr("id % 8 key", "id line", "concat('some text ', id) text")
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    assert D.searched(rows, "key").rdd.getNumPartitions() == int(tasks)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(D.line_classes(frame)) == brute(rows)


def test_repeated_lines_are_taken_out(spark):
    rows = [(1, "first line here\nsecond line here, longer"), (2, "first line herE\nown text\n\n"), (3, None)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, gone string, line_no string")
    out = {r["doc_id"]: r["text"] for r in D.drop_repeated_lines(docs).collect()}
    assert out == {1: rows[0][1], 2: "own text\n\n", 3: None}
    assert D.drop_repeated_lines(docs).columns == docs.columns


def test_odd_rows_and_empty_table(spark):
    assert D.line_classes(docs_frame(spark)).count() == len(brute([r[:2] for r in doc_rows()[:6]])) + sum(
        1 for r in doc_rows()[6:] for x in r[1].split("\n") if x.strip(D.BLANKS))
    assert D.line_classes(spark.createDataFrame([], DOCS_SCHEMA)).count() == 0
    out = D.op3_line_dedup(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "line_no", "first_doc_id", "first_line_no", "class_lines", "kept"]
