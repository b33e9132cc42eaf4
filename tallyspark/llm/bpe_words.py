"""Byte-level BPE ids by the ``tokenizers`` library, word by word where that is provably the same.

The byte-level pattern lets a blank begin a piece of text only together with the word after it, and
looks at white space beyond a piece only where white space follows white space.  So wherever a
blank stands alone (no white space on either side) a new piece begins, whatever surrounds it, and
the ids of a text without other blanks are those of its words, each with the blank before it.
A text with any other blank is encoded in one call.

The pattern also cuts between letters, digits and signs.  In words of plain characters, where no
contraction and no class of rarer characters can move these cuts, they are made beforehand, and the
library only has to merge the letters of the pieces.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK_PIECE = "\u0120"   # fixed value: how the vocabulary writes a blank
LINE_PIECE = "\u010a"    # fixed value: how it writes a line feed
# Plain letters, digits and signs (no apostrophe, which contractions begin with).
LETTER, DIGIT, SIGN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9", "!-&(-/:-@\\[-`{-~"
PLAIN = re.compile(f"(?:[{LETTER}{DIGIT}{SIGN}]|\n(?=[^\n]))+")
CUTS = re.compile("|".join(f"(?<=[{a}])(?=[^{a} ])" for a in (LETTER, DIGIT, SIGN, "\n")))
# What some library or other counts as white space, besides the blank itself.
ASCII_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
OTHER_SPACES = "".join(map(chr, [0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F,
                                 0x205F, 0x2060, 0x3000, 0xFEFF]))


def loose_blanks(text: str) -> bool:
    """Whether a blank stands next to white space, or white space at either end."""
    if not text:
        return False
    ends = " " + ASCII_SPACES + OTHER_SPACES
    if "  " in text or text[0] in ends or text[-1] in ends:
        return True
    for c in ASCII_SPACES if text.isascii() else ASCII_SPACES + OTHER_SPACES:
        if c in text and (c + " " in text or " " + c in text):
            return True
    return False


def plain(word: str) -> bool:
    return word.isascii() and word.isalpha() or PLAIN.fullmatch(word) is not None


def are_plain(words: pa.Array) -> np.ndarray:
    """``plain`` of each word, by a pattern without a look ahead."""
    return pc.match_substring_regex(words, f"\\A(?:\n?[{LETTER}{DIGIT}{SIGN}])+\\z").to_numpy(zero_copy_only=False)


def byte_of_letter() -> dict[str, int]:
    """The vocabulary's letters: printable Latin-1 bytes stand for themselves, the others are
    numbered from U+0100 on (the public byte-level alphabet)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(0x100 + n): b for n, b in enumerate(rest)}


class ByteBpe:
    """``special``: whether special strings inside texts become their ids (the library's default) or
    are ordinary text."""

    def __init__(self, path: str, special: bool = True):
        from tokenizers import Tokenizer
        self.path, self.merger = path, None
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()] if special else []
        self.vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(self.vocab.values()) + 1
        self.begins = np.zeros(self.size, bool)
        self.begins[[i for piece, i in self.vocab.items() if piece.startswith(BLANK_PIECE)]] = True

    def whole(self, text: str) -> np.ndarray:
        return self.wholes([text])[0]

    def wholes(self, texts: list[str]) -> list[np.ndarray]:
        # the batch call without offsets gives the same ids in less time
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def wordwise(self, text: str) -> bool:
        """Whether the ids are those of the words between blanks, one after another."""
        return not loose_blanks(text) and not any(s in text for s in self.special)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of " " + word for each of the words (of texts that are ``wordwise``), one after
        another, and where each begins (closed by the end).  A blank is only at the begin of a
        word, so the tokens that begin with one tell the words apart."""
        if not words:
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        ids = self.whole(" " + " ".join(words))
        return ids, np.append(np.flatnonzero(self.begins[ids]), len(ids))

    def plain_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What ``words`` gives, of words that are ``plain``."""
        if not words:
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        if self.merger is None:
            from tokenizers import Tokenizer, pre_tokenizers
            self.merger = Tokenizer.from_file(self.path)
            self.merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.letters = {b: c for c, b in byte_of_letter().items() if b >= 0x80}
        text = CUTS.sub("\t", " ".join(words))
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.letters)
        text = BLANK_PIECE + text.replace(" ", " " + BLANK_PIECE).replace("\n", LINE_PIECE)
        (found,) = self.merger.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        return ids, np.append(np.flatnonzero(self.begins[ids]), len(ids))

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id; special entries are their strings."""
        letters = byte_of_letter()
        out = [b""] * self.size
        for piece, i in self.vocab.items():
            known = all(c in letters for c in piece)
            out[i] = bytes(letters[c] for c in piece) if known else piece.encode()
        return out
