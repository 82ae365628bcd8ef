"""Word shingles as 64-bit hashes, computed over whole texts with array operations.

Words are maximal runs of letters, digits and underscores of the lower-case text.
A shingle is five words in a row; a text of one to four words has one shingle of
all of them, and a text without words has none.
"""

from __future__ import annotations

import re

import numpy as np

WORDS = 5
# Characters hashed at once; texts beyond it are cut between words.
BLOCK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_GAP = re.compile(r"\W")
_STATE: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values; equal ones stay equal, others stay distinct."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    held = _STATE.get(name)
    if held is None or len(held) < n:
        steps = np.full(max(n, BLOCK // 16), base, dtype=np.uint64)
        steps[0] = 1
        held = _STATE[name] = np.multiply.accumulate(steps)
    return held


def _word_characters() -> np.ndarray:
    if "word" not in _STATE:
        _STATE["word"] = np.array([chr(c).isalnum() or c == 95 for c in range(0x110000)])
    return _STATE["word"]


def _block_words(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = np.zeros(len(codes) + 2, dtype=np.int8)
    inside[1:-1] = _word_characters()[codes]
    turns = np.flatnonzero(np.diff(inside))
    starts, ends = turns[::2], turns[1::2]
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + _BASE) * _powers("up", _BASE, len(codes))[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers("down", _BASE_INVERSE, len(codes) + 1)[starts])


def word_hashes(text: str) -> np.ndarray:
    """A hash per word, in order."""
    text = text.lower()
    if len(text) <= BLOCK:
        return _block_words(text)
    parts, at = [], 0
    while at < len(text):
        gap = _GAP.search(text, at + BLOCK)
        end = gap.start() if gap else len(text)
        parts.append(_block_words(text[at:end]))
        at = end
    return np.concatenate(parts)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    w = word_hashes(text)
    if len(w) == 0:
        return w
    span = min(words, len(w))
    joined = w[: len(w) - span + 1].copy()
    for k in range(1, span):
        joined = joined * _MIX_2 + w[k : len(w) - span + 1 + k]
    return np.unique(mix(joined + np.uint64(span)))
