"""Pack documents into fixed windows by best fit, longest pieces first.

Every document becomes token ids and an end id. Overlong documents are cut into full windows;
what remains of each goes to the window whose free room is the tightest that still holds it.
Spark deals the pieces by hash over groups of bounded size, each packed by one task. Groups of
thousands of pieces leave hardly any padding, so more data means more groups, never larger ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shipping import ship
from tidemark.llm.token_ids import BLOCK_BYTES, encoder
from tidemark.llm.words import slices

WINDOW = 2048
GROUP_PIECES = 4096
GROUP_BYTES = 8 << 20
# An executor's JVM holds a batch several times on either way, beside its heap, and so does each Python worker.
BATCH_BYTES = 1 << 20
BATCH_PIECES = 256

PIECES = "doc_id long, start long, doc_tokens long, ids binary"
PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class RoomTree:
    """A segment tree over free room 0..most that holds how many open windows have each."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.counts[node] += n
            node >>= 1

    def tightest(self, need: int) -> int:
        """The smallest free room of at least ``need`` that some window has, or -1."""
        node = need + self.leaves
        if self.counts[node]:
            return need
        while node > 1:
            if not node & 1 and self.counts[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node + (not self.counts[2 * node])
                return node - self.leaves
            node >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; ``lengths`` must not increase and lie in 1..window."""
    windows, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = RoomTree(window), 0
    by_room: dict[int, list[int]] = {}
    for i, length in enumerate(lengths.tolist()):
        room = tree.tightest(length)
        if room < 0:
            target, room = opened, window
            opened += 1
        else:
            target = by_room[room].pop()
            tree.add(room, -1)
        windows[i], offsets[i] = target, window - room
        if room > length:
            by_room.setdefault(room - length, []).append(target)
            tree.add(room - length, 1)
    return windows, offsets


def _cut(batch: pa.RecordBatch, path: str, end_id: int, window: int) -> Iterator[pa.RecordBatch]:
    coder = encoder(path)
    for texts in slices(batch.column("text"), BLOCK_BYTES):
        ids, bounds = coder.encode(texts)
        counts = np.diff(bounds) + 1
        flat = np.empty(len(ids) + len(texts), "<u4")
        flat[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), counts - 1)] = ids
        ends = np.cumsum(counts)
        flat[ends - 1] = end_id
        n_pieces = -(-counts // window)
        docs = np.repeat(np.arange(len(texts)), n_pieces)
        starts = (np.arange(len(docs)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)) * window
        begins = (ends - counts)[docs] + starts
        at = np.append(begins, len(flat)).astype(np.int64) * 4
        ids_column = pa.Array.from_buffers(pa.large_binary(), len(docs), [None, pa.py_buffer(at), pa.py_buffer(flat)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").slice(texts.first, len(texts)).take(pa.array(docs)),
                pa.array(starts),
                pa.array(counts[docs]),
                ids_column.cast(pa.binary()),
            ],
            names=["doc_id", "start", "doc_tokens", "ids"],
        )


def token_pieces(docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """Full windows of each document and its rest, as little-endian 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _cut(batch, path, end_id, window)

    ship(docs.sparkSession, BATCH_BYTES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def pack(docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """Pieces of ``docs`` (``doc_id``, ``text``) with their place in windows of ``window`` ids.

    ``ids`` holds a piece's ids. ``sequence_id`` names a window, ``offset`` the piece's place in
    it, without gaps from 0. The same rows give the same windows, whatever their order.
    Null or empty text: the end id alone. Null ``doc_id``: kept as null. Repeated rows: packed
    each. Texts of any length: cut into full windows. No rows: no rows. Other columns: ignored.
    """
    volume = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, -(-volume[0] // GROUP_PIECES), -(-volume[1] // GROUP_BYTES))

    def place(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lengths = np.asarray(pc.binary_length(table["ids"])).astype(np.int64) // 4
        doc_ids = np.asarray(table["doc_id"].fill_null(-1))
        starts = np.asarray(table["start"])
        order = np.lexsort((starts, doc_ids, -lengths))
        windows, offsets = best_fit_decreasing(lengths[order], window)
        table = table.take(pa.array(order))
        group = table["piece_group"][0].as_py()
        placed = pa.table(
            {
                "doc_id": table["doc_id"],
                "start": table["start"],
                "length": pa.array(lengths[order]),
                "doc_tokens": table["doc_tokens"],
                "sequence_id": pa.array((group << 32) + windows),
                "offset": pa.array(offsets),
                "ids": table["ids"],
            }
        )
        return pa.Table.from_batches(placed.to_batches(max_chunksize=BATCH_PIECES))

    group = F.pmod(F.xxhash64("doc_id", "start", F.crc32("ids")), F.lit(groups))
    pieces = token_pieces(docs, path, end_id, window).withColumn("piece_group", group)
    return pieces.groupBy("piece_group").applyInArrow(place, PACKED)
