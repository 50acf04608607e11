"""Word shingles of many texts at once, as 64-bit hashes.

Words are runs of bytes other than space and tab to carriage return, after
lower-casing A-Z.  A text with fewer words than a shingle has takes its whole
word sequence as one; a text without words has none.  Two different shingles
share a hash with a chance of 2**-64.
"""

from __future__ import annotations

import numpy as np

from orderflow.llm.common import mix

_BREAK = np.zeros(256, bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# A random 64-bit value for each byte after lower-casing; nothing for a break.
_VALUE = mix(_LOWER.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
_VALUE[_BREAK] = 0
_IN_WORD = 0x9FB21C651E98DF25
_IN_SHINGLE = 0xD6E8FEB86659FD93


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(max(count, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the index of each text's first word (and of the end)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    space = _BREAK[data]
    first = np.empty(len(data), bool)
    first[0] = True
    first[1:] = space[:-1]
    first[bounds[:-1][bounds[:-1] < len(data)]] = True
    starts = np.flatnonzero(first & ~space)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    lengths = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    values = _VALUE[data[starts[0] :]]
    # Breaks after a word are worth nothing, so places beyond its end do no harm.
    values *= _powers(_IN_WORD, int(lengths.max()))[place]
    words = mix(np.add.reduceat(values, starts - starts[0]))
    return words, np.searchsorted(starts, bounds)


def shingle_hashes(
    data: np.ndarray, bounds: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each text in order, repeats included, and where each text's begin."""
    words, at = word_hashes(data, bounds)
    counts = np.diff(at)
    powers = _powers(_IN_SHINGLE, size)
    if len(words) < size:
        rolled = np.zeros(0, np.uint64)
    else:
        rolled = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            rolled += words[k : k + len(rolled)] * powers[k]
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate(([0], np.cumsum(made)))
    source = np.arange(begin[-1]) - np.repeat(begin[:-1] - at[:-1], made)
    out = np.zeros(begin[-1], np.uint64)
    inside = source < len(rolled)
    out[inside] = rolled[source[inside]]
    for text in np.flatnonzero((counts > 0) & (counts < size)):
        few = words[at[text] : at[text + 1]]
        out[begin[text]] = np.sum(few * powers[: len(few)]) + np.uint64(len(few))
    return mix(out), begin


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted."""
    hashes, begin = shingle_hashes(data, bounds, size)
    return [np.unique(hashes[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]


def shingle_set(text: str | bytes | None, size: int) -> np.ndarray:
    text = text or b""
    data = np.frombuffer(text.encode() if isinstance(text, str) else text, np.uint8)
    return shingle_sets(data, np.array([0, len(data)]), size)[0]
