"""Best-fit packing of documents into fixed-size token sequences, by sum of squares.

A document's ids and one end id are cut into pieces of at most ``capacity``.
Pieces are dealt evenly into groups of bounded size; each group is packed by one
task. A piece goes where the sum, over all residual gaps, of the squared number
of open sequences with that gap becomes smallest; this keeps many different gaps
open, so later pieces find one that they fill exactly. Longer pieces go first.

Defined cases: a null text counts as empty and gives the end id alone; rows that
repeat are packed once each; a null document id stays null; other columns of the
input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anagrove.llm.word_tokens import ChunkTokenizer
from anagrove.session import materialise

CAPACITY = 2048
END_ID = 0
# Pieces that one task packs. Sequences left part full cost a few in a thousand.
GROUP_ROWS = 65_536
TEXTS_AT_ONCE = 64

_TOKENIZERS: dict[str, ChunkTokenizer] = {}

PIECE_FIELDS = "piece int, start long, length long, ids_crc32 long"


def _tokenizer(path: str) -> ChunkTokenizer:
    """One per Python worker; its cache lasts over tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked, ``ids``."""
    narrow = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()
    limit = capacity * 4

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, data in enumerate(tokenizer.encode(part.column(1).to_pylist())):
                    data += end
                    for k, begin in enumerate(range(0, len(data), limit)):
                        own = data[begin : begin + limit]
                        row.append(i)
                        piece.append(k)
                        start.append(begin // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        if with_ids:
                            ids.append(np.frombuffer(own, dtype="<u4").astype(np.int32))
                columns = [
                    part.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_col}` {kind}, {PIECE_FIELDS}" + ", ids array<int>" * with_ids
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return narrow.mapInArrow(cut, schema)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, placed in the given order.

    ``open_bins[g]`` lists the open sequences with a gap of ``g``. Moving one from
    gap g to g - s changes the sum of squares by 2 (n[g-s] - n[g]) + 2, filling one
    up by 1 - 2 n[g], and opening one by 2 n[capacity-s] + 1.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.zeros(len(lengths), dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    bins = 0
    for k, s in enumerate(lengths.tolist()):
        gap, best = capacity, 2 * int(count[capacity - s]) + 1
        if s < capacity:
            there = count[s:capacity]
            change = 2 * (count[: capacity - s] - there) + 2
            change[0] = 1 - 2 * there[0]
            change[there == 0] = np.iinfo(np.int64).max
            i = int(change.argmin())
            if there[i] and change[i] <= best:
                gap = s + i
        if gap == capacity:
            number, bins = bins, bins + 1
        else:
            number = open_bins[gap].pop()
            count[gap] -= 1
        sequence[k], offset[k] = number, capacity - gap
        if gap > s:
            open_bins[gap - s].append(number)
            count[gap - s] += 1
    return sequence, offset


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    ``pieces`` must be a written table: its rows are counted and then dealt out
    round robin, which no key can skew and a repeated task deals alike.
    """
    groups = max(1, math.ceil(pieces.count() / group_rows))
    names = pieces.columns
    at = names.index(length_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).rename_columns([f"c{i}" for i in range(len(names))])
        keys = [(f"c{at}", "descending")] + [(f"c{i}", "ascending") for i in range(len(names)) if i != at]
        table = table.sort_by([k for k in keys if not pa.types.is_nested(table.schema.field(k[0]).type)])
        sequence, offset = place(table.column(at).to_numpy(), capacity)
        first = TaskContext.get().partitionId() << 32
        out = [*table.columns, pa.array(sequence + first), pa.array(offset)]
        yield from pa.table(out, names=[*names, "sequence_id", "offset"]).to_batches()

    return pieces.repartition(groups).mapInArrow(fill, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, **columns: str) -> DataFrame:
    """Cut and pack whole documents: one row per piece with its place."""
    return pack(materialise(token_pieces(docs, tokenizer_path, capacity, **columns)), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """Token ids of each sequence, from placed pieces that carry ``ids``."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(ordered["ids"]).alias("ids"))
