"""Operator 8: near-duplicates by SimHash, compared exactly in tiles.

A fingerprint has bit b set if more than half of the hashes of the text's shingles do, repeats counted. Equal fingerprints are
merged first. The distinct ones, in order of population counts (of the whole, then of its four 16-bit parts), are cut into tiles
of one population count. Flipping k bits changes the population counts of the parts by k in total at most, so a pair of tiles is
skipped if its counts differ by more than the radius, in whole or over the parts. The other pairs are compared by exclusive-or and bit
counts, all of one against all of the other. A pair of tiles gives a spanning forest of its links, never all pairs.

The work is quadratic in the number of distinct fingerprints, less what is skipped; memory is two tiles.

Null texts and texts without words have fingerprint zero, linked like any other. Null ids get a fingerprint and their component, whose id
is the smallest non-null id (null if there is none). Repeated rows stay rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.llm.common import return_freed_memory, slices, stored, texts
from keyrill.llm.components import components

TILE = 2048
PAIRS_PER_TASK = 200
_SEED = 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_RUN = 1 << 16


def fingerprint(text: str, width: int = 3) -> int:
    """The fingerprint of one text as an unsigned 64-bit integer."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    count = max(1, len(words) - width + 1)
    joined = b" ".join(words)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    ends = [s - 1 for s in starts[min(width, len(words)) :]]
    digest, sums = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, count, _RUN):
        shingles = zip(starts[at : at + _RUN], ends[at : at + _RUN])
        hashes = np.array([digest(joined[s:e], _SEED) for s, e in shingles], "<u8")
        sums += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums > count, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, width: int = 3) -> Column:
    """The fingerprint of each text, as a signed long of the same bits; null texts are empty."""

    @F.arrow_udf("long")
    def found(column: pa.Array) -> pa.Array:
        prints = []
        for part in slices(pa.record_batch([column], names=["text"])):
            prints += [fingerprint(t or "", width) for t in part.column("text").to_pylist()]
            return_freed_memory()
        return pa.array(np.array(prints, np.uint64).view(np.int64))

    return found(text)


def _tiles(prints: DataFrame, size: int) -> DataFrame:
    """Rows of at most `size` distinct fingerprints with one population count, and the bounds of their parts' counts."""

    def counts(fp: Column) -> list[Column]:
        parts = [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long"))) for i in range(4)]
        return [F.bit_count(fp).alias("pop"), *(p.alias(f"p{i}") for i, p in enumerate(parts))]

    def cut(batches):
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            pops = batch.column("pop").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(pops)) + 1).tolist(), len(pops)]
            for low, high in zip(edges, edges[1:]):
                for start in range(low, high, size):
                    rows = batch.slice(start, min(size, high - start))
                    parts = np.stack([rows.column(f"p{i}").to_numpy() for i in range(4)])
                    yield pa.record_batch(
                        [
                            pa.array([task << 32 | number], pa.int64()),
                            pa.array([pops[low]], pa.int32()),
                            pa.array([parts.min(axis=1).tolist()], pa.list_(pa.int32())),
                            pa.array([parts.max(axis=1).tolist()], pa.list_(pa.int32())),
                            pa.array([rows.column("fp").to_numpy().tobytes()], pa.binary()),
                        ],
                        names=["tile", "pop", "low", "high", "prints"],
                    )
                    number += 1

    ranked = prints.select("fp", *counts(F.col("fp")))
    order = ["pop", "p0", "p1", "p2", "fp"]
    ordered = ranked.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(cut, "tile long, pop int, low array<int>, high array<int>, prints binary")


def _tile_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """The pairs of tiles that can hold a link, each once, a tile with itself included."""
    shapes = tiles.select("tile", "pop", "low", "high")
    left = shapes.select(
        F.col("tile").alias("a"),
        F.col("pop").alias("own"),
        F.col("low").alias("a_low"),
        F.col("high").alias("a_high"),
        F.explode(F.sequence(F.col("pop"), F.col("pop") + radius)).alias("pop"),
    )
    gaps = [
        F.greatest(F.lit(0), F.col("low")[i] - F.col("a_high")[i], F.col("a_low")[i] - F.col("high")[i]) for i in range(4)
    ]
    near = ((F.col("own") < F.col("pop")) | (F.col("a") <= F.col("tile"))) & (sum(gaps, F.lit(0)) <= radius)
    return left.join(shapes, "pop").where(near).select("a", F.col("tile").alias("b"))


def forest(u: np.ndarray, v: np.ndarray, count: int) -> np.ndarray:
    """For each of `count` nodes the smallest node that links (u, v) reach from it."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, before[u], low)
        np.minimum.at(label, before[v], low)
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            return label


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs within `radius` bits connect, as a spanning forest: (fingerprint, a smaller node's)."""
    nodes = np.concatenate([a, b])
    held_u, held_v, held = [], [], 0
    rows = max(1, (1 << 17) // max(1, len(b)))
    for start in range(0, len(a), rows):
        near = np.bitwise_count(a[start : start + rows, None] ^ b[None, :]) <= radius
        u, v = np.nonzero(near)
        held_u.append(u + start)
        held_v.append(v + len(a))
        held += len(u)
        if held > most:
            label = forest(np.concatenate(held_u), np.concatenate(held_v), len(nodes))
            held_u, held_v = [np.flatnonzero(label != np.arange(len(nodes)))], []
            held_v, held = [label[held_u[0]]], len(held_u[0])
    if not held:
        return nodes[:0], nodes[:0]
    label = forest(np.concatenate(held_u), np.concatenate(held_v), len(nodes))
    below = np.flatnonzero(nodes[label] != nodes)
    return nodes[below], nodes[label[below]]


def links(prints: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """(u, v) between distinct fingerprints `fp`: a spanning forest of each pair of tiles."""
    tiles = stored(_tiles(prints, tile), "tiles")
    held = tiles.select("tile", "prints")
    wanted = stored(_tile_pairs(tiles, radius), "tile-pairs")
    pairs = (
        wanted.join(held.select(F.col("tile").alias("a"), F.col("prints").alias("a_prints")), "a")
        .join(held.select(F.col("tile").alias("b"), F.col("prints").alias("b_prints")), "b")
    )

    def compare(batches):
        for batch in batches:
            for x, y in zip(batch.column("a_prints"), batch.column("b_prints")):
                u, v = tile_links(*(np.frombuffer(p.as_buffer(), np.uint64) for p in (x, y)), radius)
                if len(u):
                    yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    # a pair is small and much work: dealt by pairs, not by bytes
    pairs = pairs.repartition(max(1, min(-(-wanted.count() // PAIRS_PER_TASK), 100_000)), "a", "b")
    return pairs.select("a_prints", "b_prints").mapInArrow(compare, "u long, v long")


def linked(rows: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of rows (doc_id, fp).

    root is the smallest fingerprint reachable, component_id the smallest document id.
    """
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(links(prints, radius, tile)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    placed = prints.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, tile: int = TILE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; fingerprints link at `radius` differing bits or fewer."""
    rows = stored(texts(docs).select("doc_id", fingerprints(F.col("text"), width).alias("fp")), "fingerprints")
    found = rows.join(linked(rows, radius, tile), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = 3, radius: int = 3, tile: int = TILE) -> DataFrame:
    """The rows of `docs`, all columns, that stand for their groups: the smallest id of each, a null id only where all are null.

    Of several rows with that id in a group one stays: of the smallest fingerprint, then text hash; equal texts, any.
    """
    docs = docs.withColumn("__text", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))).withColumn("__id", F.col("doc_id").cast("bigint"))
    rows = docs.select(F.col("__id").alias("doc_id"), F.col("__text").alias("text"), fingerprints(F.col("text"), width).alias("fp"))
    rows = stored(rows, "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "text")).alias("first")
    groups = rows.join(linked(rows, radius, tile), "fp")
    # by root: equal ids may be in several groups
    kept = stored(groups.groupBy("root").agg(first).select("first.*"), "representatives")
    kept = kept.select(F.col("doc_id").alias("__kept_id"), F.col("text").alias("__kept_text"))
    matches = docs["__id"].eqNullSafe(kept["__kept_id"]) & (docs["__text"] == kept["__kept_text"])
    once = docs.join(kept, matches, "left_semi")
    repeats = rows.groupBy("doc_id", F.col("text").alias("hash")).count().where("count > 1")
    if repeats.limit(1).count():
        once = once.dropDuplicates(["__id", "__text"])
    return once.drop("__id", "__text")
