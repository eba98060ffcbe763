"""Counts over a text's words, lines and characters, and its hashed n-grams."""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np

from icufeat.llm.common import WORD

words_of = re.compile(WORD).findall
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 5

#: Statistics that `statistics` returns, in order.
STATISTICS = (
    "log_chars", "log_words", "word_length", "word_length_spread", "distinct_words", "symbols", "upper_case", "digits",
    "other_signs", "words_without_letter", "short_words", "repeated_words", "repeated_lines", "log_line_length", "entropy", "commonest_word",
)


def numbered(words: list[str]) -> tuple[np.ndarray, list[str]]:
    """Numbers of the words by first appearance, and the different words."""
    known: dict[str, int] = {}
    ids = [known.setdefault(w, len(known)) for w in words]
    return np.array(ids, np.int64), list(known)


def repeated_words(ids: np.ndarray, different: int) -> int:
    """Words that lie in a window of five words found twice or more in the text."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    bits = max(1, int(different).bit_length())
    key = ids
    if bits * WINDOW <= 63:
        key = ids[:n].copy()
        for k in range(1, WINDOW):
            key = (key << bits) | ids[k : n + k]
    else:  # number the pairs, then the pairs of pairs, so that every key stays exact
        two = np.unique((ids[:-1] << 31) | ids[1:], return_inverse=True)[1]
        four = np.unique((two[:-2] << 31) | two[2:], return_inverse=True)[1]
        key = (four[:n] << 31) | ids[WINDOW - 1 :]
    ordered = np.sort(key)
    again = ordered[1:] == ordered[:-1]
    if not again.any():
        return 0
    twice = np.isin(key, np.unique(ordered[1:][again]))
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:n] += twice
    edge[WINDOW : n + WINDOW] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def symbols(text: str) -> int:
    return sum(map(text.count, SYMBOLS))


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point: 1 upper case, 2 other letter, 3 digit, 4 blank, 0 anything else."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = 1 if c.isupper() else 2
        elif c.isdigit():
            out[i] = 3
        elif c.isspace():
            out[i] = 4
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def statistics(text: str | None) -> list[float]:
    """The numbers named in STATISTICS; all finite, also for an empty or null text."""
    text = text or ""
    words = words_of(text)
    ids, different = numbered(words)
    n, chars = len(words), len(text)
    kinds = np.bincount(_classes()[code_points(text)], minlength=5).astype(float)
    letters, per = kinds[1] + kinds[2], max(1, chars)
    lengths = np.array([len(w) for w in different], float)
    times = np.bincount(ids, minlength=len(different)).astype(float) if n else np.zeros(0)
    mean = float((lengths * times).sum() / n) if n else 0.0
    spread = float(np.sqrt(max(0.0, ((lengths - mean) ** 2 * times).sum() / n))) if n else 0.0
    no_letter = np.array([not any(map(str.isalpha, w)) for w in different], float)
    lines = text.count("\n") + 1
    share = np.bincount(code_points(text) & 0x3FF).astype(float) / per  # folded, which is enough for an entropy
    share = share[share > 0]
    return [
        float(np.log1p(chars)),
        float(np.log1p(n)),
        mean,
        spread,
        len(different) / max(1, n),
        symbols(text) / per,
        kinds[1] / max(1.0, letters),
        kinds[3] / per,
        kinds[0] / per,
        float((no_letter * times).sum() / max(1, n)),
        float(((lengths <= 3) * times).sum() / max(1, n)),
        repeated_words(ids, len(different)) / max(1, n),
        repeated_lines(text) / lines,
        float(np.log1p(chars / lines)),
        float(-(share * np.log(share)).sum()) if len(share) else 0.0,
        float(times.max() / n) if n else 0.0,
    ]


def _mixed(h: np.ndarray, bits: int) -> np.ndarray:
    """The upper bits of a multiplied and folded 64-bit hash, as slots."""
    h = h ^ (h >> np.uint64(31))
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def hashed_ngrams(text: str, bits: int, ids: np.ndarray, different: list[str]) -> list[np.ndarray]:
    """Slots of the words, the word pairs, and the runs of three and of five characters, each with repeats."""
    with np.errstate(over="ignore"):
        m = np.uint64(0x100000001B3)
        own = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in different], np.uint64)[ids] if len(ids) else np.zeros(0, np.uint64)
        a = code_points(text).astype(np.uint64)
        three = (a[:-2] * m + a[1:-1]) * m + a[2:] if len(a) > 2 else a[:0]
        five = ((three[:-2] * m + a[3:-1]) * m + a[4:]) if len(a) > 4 else a[:0]
        return [
            _mixed(own + np.uint64(1), bits),
            _mixed((own[:-1] * m + own[1:]) * m + np.uint64(2), bits),
            _mixed(three * m + np.uint64(3), bits),
            _mixed(five * m + np.uint64(4), bits),
        ]
