r"""Statistics of whole texts, computed with numpy over bounded slices of texts.

Words are ``[^\x20\x09-\x0D]+`` (case kept), lines are split at ``\n``. Null and empty texts have zero everywhere.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import Words, windows

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Shares and means by which quality is learnt.
FEATURES = ["log_words", "mean_chars", "upper_share", "symbol_words", "bang_words", "bar_words", "digit_share",
            "distinct_share", "top_share", "same_as_last", "repeat_share", "dup_line_share", "single_share",
            "long_share", "stop_share", "mark_share", "line_words"]


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_SYMBOL, _MARK = _flags(SYMBOLS), _flags(".,;:?")
_UPPER, _DIGIT = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("0123456789")


def repeated_words(h: np.ndarray, row: np.ndarray, rows: int, size: int = WINDOW) -> np.ndarray:
    """Words of each row that lie in a window of ``size`` words found more than once in the row."""
    s, at = windows(h, row, size)
    if not len(s):
        return np.zeros(rows, np.int64)
    order = np.lexsort((s, row[at]))
    s, first = s[order], at[order]
    same = (s[1:] == s[:-1]) & (row[first[1:]] == row[first[:-1]])
    twice = np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    step = np.zeros(len(h) + 1, np.int64)
    np.add.at(step, first[twice], 1)
    np.add.at(step, first[twice] + size, -1)
    return np.bincount(row, np.cumsum(step[:-1]) > 0, minlength=rows).astype(np.int64)


def repeated_lines(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line, and all lines with a word, of each row."""
    dup, lines = np.zeros(words.rows, np.int64), np.zeros(words.rows, np.int64)
    raw = words.raw.tobytes()
    for k in range(words.rows):
        seen = set()
        for line in raw[words.offs[k]:words.offs[k + 1]].split(b"\n"):
            if line.strip():
                lines[k] += 1
                dup[k] += line in seen
                seen.add(line)
    return dup, lines


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS (int64) and FEATURES (float64) of each text."""
    words = Words(texts, lower=False)
    rows, row, n = words.rows, words.row, words.count
    h = words.hashes()
    data = words.raw
    # bytes of each row by kind, through running sums
    of_row = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag)])[words.offs])
    lead = (data & 0xC0) != 0x80
    accented_upper = np.zeros(len(data), bool)
    accented_upper[1:] = (data[:-1] == 0xC3) & (data[1:] < 0x9F)
    word_chars = of_row(lead & words.inside)
    n_symbols = of_row(_SYMBOL[data])
    dup, lines = repeated_lines(words)
    repeat = repeated_words(h, row, rows)
    count = lambda flag: np.bincount(row, flag, minlength=rows).astype(float)
    order = np.lexsort((h, row))
    hs, rs = h[order], row[order]
    head = np.flatnonzero(np.concatenate([[True], (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])])) if len(h) else np.zeros(0, int)
    times = np.diff(np.append(head, len(h)))
    top = np.zeros(rows)
    np.maximum.at(top, rs[head], times)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    size = words.ends - words.starts
    last = data[words.ends - 1] if len(h) else np.zeros(0, np.uint8)
    per_word, per_char = 1 / np.maximum(n, 1), 1 / np.maximum(word_chars, 1)
    out = {"n_words": n, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": dup, "n_repeat_words": repeat}
    values = [np.log1p(n), word_chars * per_word, of_row(_UPPER[data] | accented_upper) * per_char,
              count(_SYMBOL[last]) * per_word, count(last == 33) * per_word,
              count((size == 1) & (last == 124)) * per_word, of_row(_DIGIT[data]) * per_char,
              np.bincount(rs[head], minlength=rows) * per_word, top * per_word, count(same) * per_word,
              repeat * per_word, dup / np.maximum(lines, 1), count(size == 1) * per_word, count(size > 16) * per_word,
              count((size > 1) & (size < 4)) * per_word, of_row(_MARK[data]) * per_word, n / np.maximum(lines, 1)]
    return {k: v.astype(np.int64) for k, v in out.items()} | {
        k: np.where(n > 0, v, 0.0) for k, v in zip(FEATURES, values, strict=True)}


def feature_matrix(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([stats[f] for f in FEATURES], axis=1)
