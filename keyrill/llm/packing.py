"""Operator 9: packing documents into as few sequences of bounded length as possible.

Hierarchical residual packing. Each task packs blocks of at most BLOCK pieces by best fit, longest first. Bins that are nearly
full are done. The others become items of the next round, which has an eighth of the tasks, and so on until one block holds them
all or none fits another any more. Rounds are written tables of two or three numbers a bin; a piece's place is the sum of the
offsets on its way up.

Only documents longer than a sequence are cut: into full sequences, and first the remainder, if any. Null texts are empty and give one
piece of the end id. Null and equal ids keep their rows (two documents of one id have pieces of equal numbers). An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyrill.llm.common import return_freed_memory, slices, stored, texts
from keyrill.llm.tokenizing import token_ids

BLOCK = 200_000
REMEMBERED_BYTES = 72_000_000
NEARLY_FULL = 0.985
FAN_IN = 8


def document_pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece."""

    def cut(batches):
        encoder, end = token_ids(tokenizer, REMEMBERED_BYTES), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch):
                rows = []
                found, edges = encoder.encode_column(part.column("text"))
                for doc_id, low, high in zip(part.column("doc_id").to_pylist(), edges[:-1].tolist(), edges[1:].tolist()):
                    ids = found[low:high].tobytes() + end
                    count = len(ids) // 4
                    stops = [*range(count % length or min(length, count), count + 1, length)]
                    for piece, stop in enumerate(stops):
                        start = stops[piece - 1] if piece else 0
                        rows.append((doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), (pa.int64(), pa.int32(), *[pa.int64()] * 3))]
                yield pa.record_batch(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])
                return_freed_memory()

    return texts(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin: longest first, into the fullest bin with room."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    fills: list[int] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while some bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                rooms ^= 1 << r
        else:
            r, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        left = r - size
        if left:
            room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def _packed(items: DataFrame, size: str, capacity: int, level: int, block: int) -> DataFrame:
    """Each item with its bin, its offset there and the bin's fill. Bins are numbered by round, task and order."""
    names = [*items.columns, "bin", "offset", "fill"]

    def pack(batches):
        number = (level << 56) | (TaskContext.get().partitionId() << 34)

        def packed(rows):
            nonlocal number
            bins, offsets, fills = best_fit(rows.column(size).to_numpy(), capacity)
            columns = [*rows.combine_chunks().columns, pa.array(bins + number), pa.array(offsets), pa.array(fills[bins])]
            number += len(fills)
            return pa.Table.from_arrays(columns, names=names).to_batches()

        held, count = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                if count and count + part.num_rows > block:
                    yield from packed(pa.Table.from_batches(held))
                    held, count = [], 0
                held.append(part)
                count += part.num_rows
        if count:
            yield from packed(pa.Table.from_batches(held))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    return items.mapInArrow(pack, f"{schema}, bin long, offset long, fill long")


def pack_pieces(pieces: DataFrame, capacity: int = 1024, block: int = BLOCK) -> DataFrame:
    """Add sequence_id and offset to pieces of a `length` of 1 to `capacity`; places in a sequence have no gaps."""
    placed = stored(_packed(pieces, "length", capacity, 0, block), "packing-0")
    nearly = int(capacity * NEARLY_FULL)
    underfull = placed.where((F.col("offset") == 0) & (F.col("fill") < nearly)).select("bin", F.col("fill").alias("size"))
    count, rounds = underfull.count(), []
    tasks = max(1, -(-count // block))
    while count > 1:
        tasks = -(-tasks // FAN_IN)
        dealt = underfull.repartition(tasks, "bin").withColumnRenamed("bin", "item")
        found = stored(_packed(dealt, "size", capacity, len(rounds) + 1, block), "packing")
        rounds.append(found.select(F.col("item").alias("child"), F.col("bin").alias("parent"), F.col("offset").alias("shift")))
        underfull = found.where((F.col("offset") == 0) & (F.col("fill") < nearly)).select("bin", F.col("fill").alias("size"))
        before, count = count, underfull.count()
        if tasks == 1 or count == before:
            break

    top = None  # the final bin of each bin of a round, and its place there
    for moves in reversed(rounds):
        if top is not None:
            above = top.select(F.col("child").alias("parent"), F.col("parent").alias("last"), F.col("shift").alias("more"))
            moves = moves.join(above, "parent", "left").select(
                "child", F.coalesce("last", "parent").alias("parent"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")
            )
        top = moves
    if top is None:
        return placed.withColumnRenamed("bin", "sequence_id").drop("fill")
    moved = placed.join(top.withColumnRenamed("child", "bin"), "bin", "left")
    return moved.select(
        *pieces.columns,
        F.coalesce("parent", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every whole text."""
    return pack_pieces(document_pieces(docs, tokenizer, end_id, length), length)
