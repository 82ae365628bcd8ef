"""Byte-level BPE encoding and decoding with a segment tree over pair ranks.

The tree's leaves hold the rank of the pair that starts at each position; a node
holds the smaller of its children. The root is the lowest rank, and going down,
left first, finds its leftmost place. A merge changes three leaves, each in
logarithmic time, until the root shows that no pair can be merged. Short pieces are
merged many at a time: rows of one array hold their trees, and every step takes the
next merge of each. A long piece has a tree of its own.

Texts are cut as the vocabulary's pattern says. Where a text has no two white
space characters in a row, and no others than spaces and line ends, each word
with the space or line end before it is encoded independently of its neighbours;
such units are cached with their ids, decimals and bytes. Any other text is cut by
the pattern as a whole, and its pieces are the units.

Defined cases: a null text counts as empty and has no ids; the strings of special
tokens are those tokens; repeated rows give equal results; a null id stays null;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The pattern of this kind of vocabulary: a fixed value.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
UNEVEN_SPACE = re.compile(r"[^\S \n]|\s\s|\s\Z|\A\s")
NO_RANK = 1 << 60
NO_RANK_32 = (1 << 31) - 1
# Leaves of the trees that are kept as rows of one array.
LARGEST_SHARED_TREE = 32
MAX_CACHED, LONGEST_KEPT = 500_000, 64
TEXTS_AT_ONCE = 128

# Ids as bytes, their decimals joined by commas, the bytes they stand for.
Unit = tuple[bytes, str, bytes]

_CODECS: dict[str, Codec] = {}


def _shown_bytes() -> dict[str, int]:
    """Characters that stand for bytes: printable ones for themselves, the rest from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shown, spare = {}, 256
    for byte in range(256):
        if byte in printable:
            shown[chr(byte)] = byte
        else:
            shown[chr(spare)] = byte
            spare += 1
    return shown


class _PairRanks:
    """Ranks of pairs of ids, for arrays of pairs: a hash table with open addressing."""

    def __init__(self, rank: dict[tuple[int, int], int]):
        bits = max(4, (4 * len(rank)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << bits, NO_RANK_32, dtype=np.int32)
        pairs = np.array(list(rank), dtype=np.int64).reshape(-1, 2)
        key, value = pairs[:, 0] << 32 | pairs[:, 1], np.fromiter(rank.values(), np.int32, len(rank))
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = key[free]
            placed = self.keys[slot] == key
            self.ranks[slot[placed]] = value[placed]
            key, value, slot = key[~placed], value[~placed], (slot[~placed] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank per pair; pairs that can't be merged or hold a negative id have none."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        key[(left < 0) | (right < 0)] = -2
        slot = self._slot(key)
        found = np.where(self.keys[slot] == key, self.ranks[slot], NO_RANK_32)
        open_at = np.flatnonzero((self.keys[slot] != key) & (self.keys[slot] >= 0) & (key >= 0))
        while len(open_at):
            slot[open_at] = (slot[open_at] + 1) & self.mask
            there = self.keys[slot[open_at]]
            hit = there == key[open_at]
            found[open_at[hit]] = self.ranks[slot[open_at[hit]]]
            open_at = open_at[~hit & (there >= 0)]
        return found


class Codec:
    """Encodes and decodes by a byte-level BPE vocabulary file."""

    def __init__(self, path: str, max_cached: int = MAX_CACHED):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        vocabulary = given["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in given["model"]["merges"]]
        self.rank = {(vocabulary[a], vocabulary[b]): r for r, (a, b) in enumerate(pairs)}
        self.merged = [vocabulary[a + b] for a, b in pairs]
        shown = _shown_bytes()
        self.of_byte = [0] * 256
        for character, byte in shown.items():
            self.of_byte[byte] = vocabulary[character]
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, number in vocabulary.items():
            self.bytes_of[number] = bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()
        for token, number in self.special.items():
            self.bytes_of[number] = token.encode()
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.max_cached = max_cached
        self.pair_ranks = _PairRanks(self.rank)
        self.merged_ids = np.array(self.merged, dtype=np.int32)
        self.too_long: list[tuple[dict, str]] = []
        self.pieces: dict[str, bytes] = {}
        self.units: dict[str, Unit] = {}
        self.bare: dict[str, Unit] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Merge the leftmost pair of the lowest rank until none is left."""
        n = len(ids)
        if n < 2:
            return ids
        rank = self.rank.get
        size = 1
        while size < n - 1:
            size *= 2
        tree = [NO_RANK] * (2 * size)
        for i in range(n - 1):
            tree[size + i] = rank((ids[i], ids[i + 1]), NO_RANK)
        for i in range(size - 1, 0, -1):
            left, right = tree[2 * i], tree[2 * i + 1]
            tree[i] = left if left <= right else right
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (lowest := tree[1]) != NO_RANK:
            i = 1
            while i < size:
                i *= 2
                if tree[i] != lowest:
                    i += 1
            at = i - size
            gone = following[at]
            ids[at] = self.merged[lowest]
            after, ahead = following[gone], before[at]
            following[at] = after
            if gone < n - 1:
                tree[size + gone] = NO_RANK
            if after < n:
                before[after] = at
                tree[size + at] = rank((ids[at], ids[after]), NO_RANK)
            else:
                tree[size + at] = NO_RANK
            low = size + at
            if ahead >= 0:
                tree[size + ahead] = rank((ids[ahead], ids[at]), NO_RANK)
                low = size + ahead
            # The changed leaves' paths to the root, level by level; most soon meet.
            middle, high = (size + at) >> 1, (size + min(gone, n - 2)) >> 1
            low >>= 1
            while low:
                left, right = tree[2 * low], tree[2 * low + 1]
                tree[low] = left if left <= right else right
                if middle != low:
                    left, right = tree[2 * middle], tree[2 * middle + 1]
                    tree[middle] = left if left <= right else right
                if high != middle:
                    left, right = tree[2 * high], tree[2 * high + 1]
                    tree[high] = left if left <= right else right
                low, middle, high = low >> 1, middle >> 1, high >> 1
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = following[i]
        return out

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit bytes."""
        out = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            size = 1 << max(len(piece) - 2, 0).bit_length()
            if size <= LARGEST_SHARED_TREE:
                classes.setdefault(size, []).append(i)
            else:
                ids = self.merge([self.of_byte[b] for b in piece])
                out[i] = np.array(ids, dtype="<u4").tobytes()
        for size, members in classes.items():
            for i, ids in zip(members, self._merge_rows([pieces[i] for i in members], size), strict=True):
                out[i] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Merge pieces of at most ``size`` + 1 bytes; row r of each array belongs to piece r."""
        rows, width = len(pieces), size + 2
        lengths = np.fromiter(map(len, pieces), np.int64, rows)
        given = np.frombuffer(b"".join(p.ljust(size + 1, b"\0") for p in pieces), dtype=np.uint8).reshape(rows, size + 1)
        ids = np.full((rows, width), -1, dtype=np.int32)
        ids[:, :-1] = np.array(self.of_byte, dtype=np.int32)[given]
        ids[np.arange(width)[None, :] >= lengths[:, None]] = -1
        tree = np.empty((rows, 2 * size), dtype=np.int32)
        tree[:, size:] = self.pair_ranks.of(ids[:, :size].ravel(), ids[:, 1 : size + 1].ravel()).reshape(rows, size)
        for level in (1 << k for k in reversed(range(size.bit_length() - 1))):
            np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2], out=tree[:, level : 2 * level])
        following = np.tile(np.minimum(np.arange(1, width + 1), width - 1), (rows, 1)).ravel()
        before = np.tile(np.arange(-1, width - 1), (rows, 1)).ravel()
        ids, tree = ids.ravel(), tree.ravel()
        active = np.arange(rows)
        while True:
            lowest = tree[active * (2 * size) + 1]
            going = lowest != NO_RANK_32
            active, lowest = active[going], lowest[going]
            if not len(active):
                break
            own, root = active * width, active * (2 * size)
            node = np.ones(len(active), dtype=np.int64)
            for _ in range(size.bit_length() - 1):
                node *= 2
                node += tree[root + node] != lowest
            at = node - size
            gone, ahead = following[own + at], before[own + at]
            after = following[own + gone]
            new = self.merged_ids[lowest]
            ids[own + at] = new
            ids[own + gone] = -1
            following[own + at] = after
            before[own + after] = at
            led = ahead >= 0
            tree[root + size + at] = self.pair_ranks.of(new, ids[own + after])
            tree[(root + size + gone)[gone < size]] = NO_RANK_32
            first = np.where(led, ahead, at)
            tree[(root + size + ahead)[led]] = self.pair_ranks.of(ids[(own + ahead)[led]], new[led])
            # The changed leaves' paths to the root, level by level.
            node = np.concatenate([first, at, np.minimum(gone, size - 1)]) + size
            root = np.tile(root, 3)
            for _ in range(size.bit_length() - 1):
                node >>= 1
                child = root + 2 * node
                tree[root + node] = np.minimum(tree[child], tree[child + 1])
        ids = ids.reshape(rows, width)
        kept = ids >= 0
        data = ids[kept].astype("<u4").tobytes()
        ends = (np.cumsum(kept.sum(axis=1)) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _fill_pieces(self, pieces: set[str]) -> None:
        fresh = list(pieces.difference(self.pieces))
        self.too_long.extend((self.pieces, p) for p in fresh if len(p) > LONGEST_KEPT)
        self.pieces.update(zip(fresh, self.merge_many([p.encode("utf-8") for p in fresh]), strict=True))

    def _joined(self, pieces: list[str], starts: list[int]) -> list[Unit]:
        """Units of the pieces from each start to the next."""
        ids = list(map(self.pieces.__getitem__, pieces))
        upto = [0, *np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))).tolist()]
        data = b"".join(ids)
        numbers = np.frombuffer(data, dtype="<u4").tolist()
        decimals, shown = list(map(self.decimal.__getitem__, numbers)), list(map(self.bytes_of.__getitem__, numbers))
        edges = [upto[i] for i in [*starts, len(pieces)]]
        return [
            (data[a:b], ",".join(decimals[a >> 2 : b >> 2]), b"".join(shown[a >> 2 : b >> 2]))
            for a, b in zip(edges, edges[1:], strict=False)
        ]

    def _fill(self, held: dict[str, Unit], keys: set[str], mark: str) -> None:
        """Encode the units that ``held`` lacks; a unit is a key after ``mark``, a line end stands for itself.

        All are cut in one go. A unit's first piece is the one that starts with
        ``mark``, which no other piece does.
        """
        fresh = list(keys.difference(held))
        if not fresh:
            return
        self.too_long.extend((held, key) for key in fresh if len(key) > LONGEST_KEPT)
        cut = PATTERN.findall(mark + mark.join(fresh))
        starts = [i for i, p in enumerate(cut) if p[0] == mark]
        self._fill_pieces(set(cut))
        if mark == "\n":
            cut = [p for p in cut if p != mark]
            starts = [i - k for k, i in enumerate(starts)]
        held.update(zip(fresh, self._joined(cut, starts), strict=True))

    def _units_of(self, texts: list[str]) -> list[list[Unit]]:
        """Units of each text, in order."""
        if len(self.pieces) + len(self.units) > self.max_cached:
            for cache in (self.pieces, self.units, self.bare):
                cache.clear()
        out: list[list[Unit]] = [[]] * len(texts)
        even, uneven = {}, {}
        for i, text in enumerate(texts):
            if self.cut_special and self.cut_special.search(text):
                parts = self.cut_special.split(text)
                cut = [[p] if k % 2 else PATTERN.findall(p) for k, p in enumerate(parts)]
                out[i] = [u for k, pieces in enumerate(cut) for u in (self._special(pieces[0]) if k % 2 else self._whole(pieces))]
            elif UNEVEN_SPACE.search(text):
                uneven[i] = PATTERN.findall(text)
            elif text:
                even[i] = text.replace("\n", " \n").split(" ")
        after_line = {w for words in even.values() for w in words[1:] if w[0] == "\n"}
        self._fill(self.bare, {words[0] for words in even.values()}.union(w[1:] for w in after_line), "\n")
        ids, decimals, shown = self._whole(["\n"])[0]
        for word in after_line.difference(self.units):
            own = self.bare[word[1:]]
            self.units[word] = ids + own[0], f"{decimals},{own[1]}", shown + own[2]
            if len(word) > LONGEST_KEPT:
                self.too_long.append((self.units, word))
        self._fill(self.units, set().union(*[words[1:] for words in even.values()]), " ")
        of = self.units.__getitem__
        for i, words in even.items():
            out[i] = [self.bare[words[0]], *map(of, words[1:])]
        for i, pieces in uneven.items():
            out[i] = self._whole(pieces)
        for cache, key in self.too_long:
            cache.pop(key, None)
        self.too_long.clear()
        return out

    def _special(self, token: str) -> list[Unit]:
        number = self.special[token]
        return [(np.array([number], dtype="<u4").tobytes(), self.decimal[number], self.bytes_of[number])]

    def _whole(self, pieces: list[str]) -> list[Unit]:
        """All pieces as one unit."""
        self._fill_pieces(set(pieces))
        return self._joined(pieces, [0] if pieces else [])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [np.frombuffer(b"".join([u[0] for u in units]), dtype="<u4") for units in self._units_of(texts)]

    def round_trip(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Per text its number of ids, the ids as decimals joined by commas, and the text decoded from them."""
        for units in self._units_of(texts):
            ids, decimals, shown = zip(*units, strict=True) if units else ((), (), ())
            yield sum(map(len, ids)) // 4, ",".join(decimals), b"".join(shown).decode("utf-8", errors="replace")

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


def codec(path: str) -> Codec:
    """One per Python worker; its caches last over tasks."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _mapped(docs: DataFrame, columns: list[str], run, schema: str) -> DataFrame:
    """Apply ``run`` to slices of each batch of ``columns``; the first column stays."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                new = run(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), *new.values()], names=[columns[0], *new])

    kind = docs.schema[columns[0]].dataType.simpleString()
    return docs.select(*columns).mapInArrow(each, f"`{columns[0]}` {kind}, {schema}")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``ids`` (array of int) per row."""

    def run(texts: pa.Array) -> dict[str, pa.Array]:
        ids = codec(path).encode([t or "" for t in texts.to_pylist()])
        return {"ids": pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))}

    return _mapped(docs, [id_col, text_col], run, "ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Id and ``text`` per row."""

    def run(ids: pa.Array) -> dict[str, pa.Array]:
        return {"text": pa.array([codec(path).decode(i or []) for i in ids.to_pylist()], pa.string())}

    return _mapped(encoded, [id_col, ids_col], run, "text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, in one pass over the texts."""

    def run(texts: pa.Array) -> dict[str, pa.Array]:
        n, ids_digest, text_digest = [], [], []
        for count, decimals, text in codec(path).round_trip([t or "" for t in texts.to_pylist()]):
            n.append(count)
            ids_digest.append(hashlib.sha256(decimals.encode()).hexdigest())
            text_digest.append(hashlib.sha256(text.encode()).hexdigest())
        return {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_digest), "decoded_sha256": pa.array(text_digest)}

    return _mapped(docs, [id_col, text_col], run, "n_tokens long, ids_sha256 string, decoded_sha256 string")
