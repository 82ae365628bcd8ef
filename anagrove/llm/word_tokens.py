"""Token ids of whole texts by a word-level tokenizer file, with a bounded cache.

The tokenizers library spends most of its time on words it has just seen. A
vocabulary that drops white space never lets a token cross it, so each chunk
between white space has its ids independently of its neighbours, and a cache of
chunks gives exactly the library's result. A full cache becomes the older one, from
which chunks that come up again are taken over, and the oldest is let go.

A chunk of letters alone is one word to the library, as is one with a comma or full
stop behind it to that mark; so such words are encoded without their marks, and where
one ends is told by its last id.
"""

from __future__ import annotations

import os
import re

import numpy as np

# Python's split() also cuts at these; the library's \s does not hold them.
NOT_WHITE_SPACE_IN_LIBRARY = re.compile("[\x1c-\x1f]")
MAX_CACHED_CHUNKS = 300_000
MARKS = ",."


def _folded(text: str) -> str:
    """Lower case where that is sure to be the library's own; more chunks are then alike.

    Strings of special tokens are matched before case is folded, so texts that might
    hold one stay as they are.
    """
    if "<|" in text:
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def _is_word(chunk: str) -> bool:
    """Letters alone, of an alphabet that no normal form changes."""
    return chunk.isalpha() and (chunk.isascii() or max(chunk) <= "\xff")


class ChunkTokenizer:
    """Encodes texts chunk by chunk; ids come as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, max_cached: int = MAX_CACHED_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.max_cached = max_cached
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, from one call over all of them with a space between."""
        encoded = self.library.encode(" ".join(chunks), add_special_tokens=False)
        ids = np.asarray(encoded.ids, dtype="<u4").tobytes()
        starts = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1)
        begins = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)[:, 0]
        ends = (np.searchsorted(begins, starts) * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word of letters alone: up to the first that ends a word."""
        ids = np.asarray(self.library.encode(" ".join(words), add_special_tokens=False).ids, dtype="<u4")
        data, ends = ids.tobytes(), ((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _fill(self, chunks: set[str]) -> None:
        """Have the ids of all chunks in the cache."""
        fresh = chunks.difference(self.cache)
        again = {c for c in fresh if c in self.older}
        self.cache.update((c, self.older[c]) for c in again)
        fresh -= again
        marked = [c for c in fresh if c[-1] in MARKS and _is_word(c[:-1])]
        stems = {c[:-1] for c in marked}.union(c for c in fresh if _is_word(c)).difference(self.cache)
        words = list(stems)
        self.cache.update(zip(words, self._encode_words(words), strict=True))
        rest = list(fresh.difference(self.cache, marked).union(m for m in MARKS if marked and m not in self.cache))
        self.cache.update(zip(rest, self._encode_chunks(rest), strict=True))
        of = self.cache
        of.update([(c, of[c[:-1]] + of[c[-1]]) for c in marked])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, in order."""
        odd = {i for i, t in enumerate(texts) if NOT_WHITE_SPACE_IN_LIBRARY.search(t)}
        chunks = [[] if i in odd else _folded(t).split() for i, t in enumerate(texts)]
        if len(self.cache) > self.max_cached:
            self.older, self.cache = self.cache, {}
        self._fill(set().union(*chunks))
        of = self.cache.__getitem__
        out = [b"".join(map(of, c)) for c in chunks]
        for i in odd:
            out[i] = self._encode(texts[i])
        return out
