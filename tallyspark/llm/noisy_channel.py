"""Noisy-channel restoration of disguised words: leetspeak, spacing and repetition.

A written unit (a token, or a run of spaced single characters) is a lattice: every run of equal
characters may stand for one or two letters, a digit or sign for a letter that it looks like, for
a break between words or for nothing, a letter with a mark for the bare letter.  Viterbi decoding
finds the reading with the least cost of channel and character model (four letters, within
words).  Decoding is exact: a state is the last three letters, no path is pruned but for a
better one to the same state.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import groupby

import numpy as np

LETTERS = "abcdefghijklmnopqrstuvwxyz"
BREAK, OTHER, SIZE = 0, 27, 28      # a break between words, any other letter, letters in all
CONTEXTS = SIZE ** 3                # what three letters can be
CELLS = SIZE ** 4                   # counts of the character model, whatever the corpus
# Costs of the channel (natural logarithms of how unlikely the writer's step is); fixed values.
LEET, DOUBLE, REPEAT, DROP, SPLIT, MARK = 2.0, 2.5, 1.0, 2.0, 0.5, 1.5
# Which letters a sign may stand for; fixed values.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
         "*": "aeiou", "#": "h", "%": "x", "&": "a"}
# Letters of other scripts that look like Latin ones; fixed values.
LOOKALIKES = dict(zip("аеорсхіуктвмнαοιρτυ", "aeopcxiyktbmhaoiptu"))
UNSEEN = dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF])      # signs without a shape
DOUBLED = re.compile(r"(.)\1", re.DOTALL)
CHOICES = re.compile(r"(.)\1+|[^a-z]", re.DOTALL)      # where something may be read in several ways
REMEMBERED = 50_000                 # stretches of a lattice that a restorer remembers
EDGES = ".,;:?\"'`)]}>[{/\\_-~^=…“”‘’«»–—"     # signs that never stand for a letter

_CODES = np.zeros(256, np.uint8)
_CODES[[ord(c) for c in LETTERS]] = _CODES[[ord(c) for c in LETTERS.upper()]] = np.arange(1, 27)
_CODES[0xC0:] = OTHER                # the first byte of any other character
_CODES[0x80:0xC0] = 255              # its other bytes


def cell_counts(data: bytes) -> np.ndarray:
    """How often each letter (or break) follows three letters; contexts begin anew in every word.
    ``data`` is UTF-8."""
    c = _CODES[np.frombuffer(data, np.uint8)]
    c = c[c != 255]
    c = np.concatenate([[BREAK], c, [BREAK]]).astype(np.int64)
    c = c[np.append(True, (c[1:] != BREAK) | (c[:-1] != BREAK))]
    one = c[:-1]
    two = np.where(one != BREAK, np.concatenate([[BREAK], c[:-2]]), BREAK)
    three = np.where(two != BREAK, np.concatenate([[BREAK, BREAK], c[:-3]])[:len(two)], BREAK)
    return np.bincount(((three * SIZE + two) * SIZE + one) * SIZE + c[1:], minlength=CELLS)


def costs(counts: np.ndarray) -> np.ndarray:
    """-log of the smoothed probabilities: each length of context falls back on the next shorter one as
    often as new letters follow it (Witten-Bell), the empty one on equal chances."""
    full = counts.reshape((SIZE,) * 4).astype(float)
    p = np.full(SIZE, 1.0 / SIZE)
    for context in range(4):
        n = full.sum(axis=tuple(range(3 - context))) if context < 3 else full
        total, kinds = n.sum(axis=-1, keepdims=True), (n > 0).sum(axis=-1, keepdims=True)
        p = np.where(total > 0, (n + kinds * p) / np.maximum(total + kinds, 1), p)
    return -np.log(p).astype(np.float32).ravel()


def base_letter(c: str) -> str | None:
    """The Latin letter that a letter with a mark, or of another script, looks like."""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    first = unicodedata.normalize("NFKD", c)[0]
    return first if first in LETTERS else None


def readings(c: str, n: int) -> list[tuple[tuple[tuple[int, str], ...], float]]:
    """What ``n`` equal characters (three stand for more) may stand for: (letters with their codes, cost)."""
    if c.isalpha():
        code = LETTERS.find(c) + 1 or OTHER
        letters = [((code, c), 0.0)]
        base = base_letter(c) if code == OTHER else None
        if base:
            letters.append(((LETTERS.index(base) + 1, base), MARK))
        out = []
    else:
        letters = [((LETTERS.index(x) + 1, x), LEET) for x in SIGNS.get(c, "")]
        out = [(((BREAK, ""),), SPLIT if c in SIGNS else 0.0), ((), DROP)]
    for letter, cost in letters:
        out.append(((letter,), cost + (0.0, DOUBLE, REPEAT)[n - 1]))
        if n > 1:
            out.append(((letter, letter), cost + (REPEAT if n > 2 else 0.0)))
    return out


class Restorer:
    def __init__(self, cost: np.ndarray):
        self.cost = cost.tolist()
        self.options: dict[tuple[str, int], list] = {}
        self.stretches: dict[tuple[str, int, int], str] = {}

    def words(self, unit: str) -> tuple[str, ...]:
        """The words that a unit most likely stands for."""
        plain = unit.strip(EDGES)
        if plain.isascii() and plain.isalpha():
            lower = plain.lower()
            if not DOUBLED.search(lower):
                return (lower,)              # a lattice with one path
        else:
            plain = unicodedata.normalize("NFKC", unit.translate(UNSEEN)).strip(EDGES)
            if not any(map(str.isalpha, plain)):
                return ()
        return tuple(self._best(plain.lower()).split())

    def _best(self, text: str) -> str:
        """The best path.  Three letters in a row that have one reading bring all states together, so the
        lattice falls apart there: a stretch of choices depends on three letters on either side only, and
        is decoded once."""
        cuts: list[list[int]] = []
        for m in CHOICES.finditer(text):
            if cuts and m.start() - cuts[-1][1] < 3:
                cuts[-1][1] = m.end()
            else:
                cuts.append([*m.span()])
        out, at = [], 0
        for start, end in cuts:
            before, after = max(start - 3, 0), min(end + 3, len(text))
            key = text[before:after], start - before, after - end
            found = self.stretches.get(key)
            if found is None:
                found = self._decoded(*key)
                if len(self.stretches) >= REMEMBERED:
                    self.stretches.clear()
                if len(key[0]) <= 64:
                    self.stretches[key] = found
            out += text[at:start], found
            at = end
        return "".join(out) + text[at:]

    def _decoded(self, text: str, before: int, after: int) -> str:
        """The best reading of a stretch without the single letters ``before`` and ``after`` it."""
        best = self._path(text)
        return best[before:len(best) - after]

    def _path(self, text: str) -> str:
        cost, options = self.cost, self.options
        states: dict[int, tuple] = {0: (0.0, None)}        # last three letters -> cost, letters so far
        for c, run in groupby(text):
            n = min(sum(1 for _ in run), 3)
            ways = options.get((c, n))
            if ways is None:
                ways = options[c, n] = readings(c, n)
            if len(ways) == 1 and len(states) == 1:         # nothing to choose
                ((code, letter),), step = ways[0]
                ((at, (so_far, path)),) = states.items()
                at = at * SIZE + code
                states = {at % CONTEXTS: (so_far + step + cost[at], (letter, path))}
                continue
            then: dict[int, tuple] = {}
            for at, (so_far, path) in states.items():
                for letters, step in ways:
                    last, total, way = at, so_far + step, path
                    for code, letter in letters:
                        if code == BREAK:
                            if last:
                                total += cost[last * SIZE]
                                last, way = 0, (" ", way)
                        else:
                            last = last * SIZE + code
                            total += cost[last]
                            last, way = last % CONTEXTS, (letter, way)
                    if last not in then or total < then[last][0]:
                        then[last] = (total, way)
            states = then
        _, way = min(((total + (cost[last * SIZE] if last else 0.0), way) for last, (total, way) in states.items()),
                     key=lambda x: x[0])
        out = []
        while way is not None:
            letter, way = way
            out.append(letter)
        return "".join(reversed(out))


def units(text: str) -> set[str]:
    """The different tokens of a text, and its runs of three or more single characters between blanks."""
    tokens = text.split()
    out = set(tokens)
    single = [i for i, w in enumerate(tokens) if len(w) == 1]
    start = 0
    for j in range(1, len(single) + 1):
        if j == len(single) or single[j] != single[j - 1] + 1:
            if j - start >= 3:
                out.add(" ".join(tokens[single[start]:single[j - 1] + 1]))
            start = j
    return out
