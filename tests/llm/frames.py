"""Small hand-made frames: the odd cases every operator has to take."""

from __future__ import annotations

LONG = " ".join(f"w{i % 97}x{i % 31}" for i in range(30_000))

# doc_id, text, lang, source, n_chars, and columns whose names the operators use inside
DOCS_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
               "id string, digest int, run string, n_words string, kept string, batch int, "
               "`a.b` int, stay string, s string, verdict string")
PARAGRAPH = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))


def doc_rows():
    texts = [
        (1, "Hello World", "en", "a"), (2, "hello world", "en", "a"), (3, "HELLO world", None, "b"),
        (4, None, "en", "a"), (5, "", "en", None), (6, "  \t\n ", "en", "a"),
        (7, LONG, "en", "a"), (8, LONG.upper(), "en", "b"), (9, "Ünïcode ÄÖ ü", "de", "a"),
        (9, "Ünïcode ÄÖ ü", "de", "a"), (9, "ünïcode äö ü", "de", "a"), (None, "no id", "en", "a"),
        (None, "no id", "en", "a"), (10, "no id", "en", "a"), (11, "a b c d e", "en", "a"),
        (12, PARAGRAPH, "en", "a"), (13, PARAGRAPH + " tail", "en", "a"), (14, "one", "en", "a"),
        (15, "a b c a b c a b c\nx\nx\n\n x", "en", "a"), (16, "#*$%&|<> " * 30, "en", "b"),
    ]
    return [(i, t, lang, s, None, "clash", 0, "clash", "clash", "clash", 0, 1, "clash", None, "clash")
            for i, t, lang, s in texts]


def docs_frame(spark, rows=None):
    return spark.createDataFrame(doc_rows() if rows is None else rows, DOCS_SCHEMA)
