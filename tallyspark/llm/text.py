"""Text expressions shared by the operators: ASCII lower-casing and ASCII-blank words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters that are lower-cased and the blanks that separate words.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[ \\t-\\r]+"
NOT_BLANK = "[^ \\t-\\r]"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  On an all-ASCII text that is what ``lower`` does, byte-wise."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Maximal runs of non-blank characters, in order."""
    return F.array_remove(F.split(text, BLANK_RUN), "")


def text_key(text: Column) -> Column:
    """A 128-bit digest of the text; NULL counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``: a column
    referenced inside a lambda is otherwise computed again for every element."""
    return F.transform(F.array(value), body)[0]


def as_they_are(columns: list[str]) -> list[Column]:
    """The columns by their names, whatever characters these hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def columns_free_of(columns: list[str], *wanted: str) -> dict[str, str]:
    """Working names for columns that ``columns`` (compared without case) does not have."""
    taken = {c.lower() for c in columns}
    out = {}
    for name in wanted:
        free = name
        while free.lower() in taken:
            free += "_"
        taken.add(free.lower())
        out[name] = free
    return out
