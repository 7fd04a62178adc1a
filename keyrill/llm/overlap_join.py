"""Operator 11: documents whose sets of word shingles have a Jaccard similarity of at least 90 %, by T-occurrence search.

Documents of equal sets are one class, found by a 128-bit digest of the set. For two classes of a and b shingles to link they must
share T >= 0.9 max(a, b) of them. A class's shingles are put in one order for all, rare ones first. As DivideSkip does, the
inverted lists of the shingles that come last are set aside as long ones: of n, all but the first n - ceil(0.9 n) + t. Two linked
classes share at least t of the short lists (t is 2, or fewer where they must share fewer). Short lists are merged by a heap, which counts
in how many of them a class occurs; those that occur t times are looked up in all lists by binary search, and kept where they reach T.

The order. A quarter of all shingles, chosen by hash, come first, by the number of classes they occur in, then hash; so only these are counted.
Shingles that a bounded sample of documents shows in more than a hundredth of them come last of all, the other three quarters
between. Any order gives the same links; this one makes most lists those of a shingle that one class has, and these are never made.

A list may hold a third of all classes, all of them near copies of each other. Lists are therefore first used to propose one pair for each entry,
with a leader of its list, and what links that way is put into components. The search proper is then for links between
different components alone: a list is merged for its entries outside its largest component, in chunks of bounded length. No
pair within a component is made, none between components is lost. A list's entries carry 256 bits, each the parity of the number of the
set's shingles that fall on it: sets differ in at least as many shingles as their bits do, so an entry that differs in
more than a link allows is not asked for.

A shingle is told by a 64-bit hash, so two documents could count two different shingles as one with a probability of about a * b / 2^64.
Null texts and texts without words have empty sets and are their own components. Null ids get the component of their class: the smallest
non-null id, null if there is none. Equal ids and repeated rows stay rows. A very long text takes some thirty times its size in a task. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyrill.llm.common import return_freed_memory, slices, stored, string_buffer, texts
from keyrill.llm.components import components
from keyrill.llm.words import Hasher, scan

WIDTH = 3
PERCENT = 90
SHARED = 2
SAMPLE = 4_000
FREQUENT = 0.01
MOST_FREQUENT = 200_000
LEADER_ROUNDS = 2
CHUNK = 512
BROADCAST_ROWS = 2_000_000
_COUNTED = np.uint64(4)  # one shingle in so many is counted
_SEED = 11


def shingle_sets(column: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles; A-Z count as a-z. Nulls are empty."""
    data, offsets = string_buffer(column)
    data = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    hasher = _hasher()
    starts, ends, first = scan(data, offsets)
    words = hasher.words(data, starts, ends)
    windows = hasher.windows(words, width)
    found = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= width:
            found.append(np.unique(windows[low : high - width + 1]))
        elif high > low:
            whole = xxhash.xxh64_intdigest(words[low:high].tobytes(), seed=_SEED)
            found.append(np.array([whole], np.uint64))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


_hashers: dict[int, Hasher] = {}


def _hasher() -> Hasher:
    if _SEED not in _hashers:
        _hashers[_SEED] = Hasher(_SEED)
    return _hashers[_SEED]


def least_overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """How many shingles sets of a and b must share: 100 * shared >= percent * (a + b - shared)."""
    return -(-percent * (a + b) // (100 + percent))


def _own_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def parities(found: np.ndarray) -> np.ndarray:
    """Four words of 64 bits; the bits of two sets differ in no more places than the sets do in shingles."""
    counts = np.bincount((found >> np.uint64(8) & np.uint64(255)).astype(np.int64), minlength=256)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8")


def asked_for(asking: pa.StructArray, held: pa.StructArray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the entries `asking` of a list look for which of the entries `held`: of smaller components, if they can link at all."""

    def columns(entries: pa.StructArray) -> tuple[np.ndarray, ...]:
        n, members, comp = (entries.field(c).to_numpy() for c in ("n", "members", "comp"))
        return n, members, comp, entries.field("bits").flatten().to_numpy().view(np.uint64).reshape(-1, 4)

    n, members, comp, bits = (x[:, None] for x in columns(asking))
    of_n, of_members, of_comp, of_bits = (x[None] for x in columns(held))
    smaller = (of_members < members) | ((of_members == members) & (of_comp < comp))
    alike = np.minimum(n, of_n) * 100 >= np.maximum(n, of_n) * percent
    differ = np.bitwise_count(bits ^ of_bits).sum(axis=2, dtype=np.int64)
    shared = -(-percent * (n + of_n) // (100 + percent))
    return np.nonzero(smaller & alike & (differ <= n + of_n - 2 * shared))


def _needed(n: Column, percent: int) -> Column:
    """How many short lists a set must share with any it links to."""
    return F.least(F.lit(SHARED), F.ceil(n * percent / F.lit(100)))


def frequent_shingles(rows: DataFrame, width: int = WIDTH, sample: int = SAMPLE) -> np.ndarray:
    """Sorted hashes of shingles in more than FREQUENT of a sample of about `sample` rows; at most MOST_FREQUENT.

    Which they are decides how much work is done, never what is found.
    """
    share = max(1, rows.count() // sample)
    place = F.xxhash64(F.monotonically_increasing_id())
    sampled = rows.select("text", place.alias("place")).where(F.pmod("place", F.lit(share)) == 0).select("text")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = shingle_sets(part.column("text"), width)
                yield pa.record_batch([pa.array(np.concatenate(found).view(np.int64))], names=["h"])

    least = max(8, int(FREQUENT * sampled.count()))
    counts = sampled.mapInArrow(distinct, "h long").groupBy("h").count().where(F.col("count") > least)
    most = counts.orderBy(F.desc("count"), "h").limit(MOST_FREQUENT).select("h").toArrow()
    return np.sort(most.column("h").to_numpy().view(np.uint64))


def _posted(rows: DataFrame, frequent: np.ndarray, width: int, percent: int) -> DataFrame:
    """(doc_id, n, key, bits, counted, more) of each row.

    `key` tells its set, `bits` are its parities, `counted` are the shingles to be counted, `more` those that are in its short lists whatever the counts.
    """

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys, sizes, bits, counted, more = [], [], [], [], []
                for found in shingle_sets(part.column("text"), width):
                    sizes.append(len(found))
                    keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                    bits.append(parities(found))
                    often = np.zeros(len(found), bool)
                    if len(frequent):
                        often = frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] == found
                    first = (found % _COUNTED == 0) & ~often
                    overlap = _own_overlap(len(found), percent)
                    missing = len(found) - overlap + min(SHARED, overlap) - int(first.sum())
                    counted.append(found[first].view(np.int64))
                    more.append(np.concatenate([found[~first & ~often], found[often]])[: max(0, missing)].view(np.int64))
                columns = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary())]
                columns += [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, c)]), pa.int32()), pa.array(np.concatenate(c))) for c in (bits, counted, more)]
                yield pa.record_batch(columns, names=["doc_id", "n", "key", "bits", "counted", "more"])
                return_freed_memory()

    return rows.mapInArrow(posted, "doc_id long, n long, key binary, bits array<long>, counted array<long>, more array<long>")


def _short_lists(classes: DataFrame, percent: int) -> DataFrame:
    """(h, cls, n): the entries of all short lists that have more than one."""
    postings = classes.select("cls", F.explode("counted").alias("h"))
    by_shingle = Window.partitionBy("h")
    common = postings.withColumn("df", F.count("*").over(by_shingle)).where("df > 1")
    shared = common.groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("shared"))
    sizes = classes.select("cls", "n", F.size("counted").alias("counted"), "more")
    placed = sizes.join(shared, "cls", "left")
    short = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + _needed(F.col("n"), percent)
    alone = F.col("counted") - F.when(F.col("shared").isNull(), 0).otherwise(F.size("shared"))
    rare = F.coalesce(F.slice("shared", F.lit(1), F.greatest(F.lit(0), short - alone).cast("int"))["h"], F.array().cast("array<long>"))
    entries = placed.select("cls", "n", F.explode(F.concat(rare, "more")).alias("h"))
    return entries.withColumn("df", F.count("*").over(by_shingle)).where("df > 1").select("h", "cls", "n")


def _sets(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cls, found) of the `wanted` classes (cls, key, least): their sorted shingles, packed."""
    ids = wanted.select(F.col("least").alias("of")).distinct()
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    again = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("of")), "left_semi").select("text")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [s.tobytes() for s in shingle_sets(part.column("text"), width)]
                keys = [xxhash.xxh3_128_digest(s) for s in found]
                yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(found, pa.binary())], names=["key", "found"])

    held = again.mapInArrow(packed, "key binary, found binary")
    # rows of an id with other texts, and copies, fall away
    return held.join(wanted.select("key", "cls"), "key").groupBy("cls").agg(F.first("found").alias("found"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that share enough: the shingles of the smaller set are looked up in the other by binary search."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                a, b = sorted((np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y)), key=len)
                shared = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
                keep.append(shared >= least_overlap(len(a), len(b), percent))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    held = pairs.join(sets.select(F.col("cls").alias("u"), F.col("found").alias("x")), "u")
    held = held.join(sets.select(F.col("cls").alias("v"), F.col("found").alias("y")), "v")
    return held.select("u", "v", "x", "y").mapInArrow(check, "u long, v long")


def _alike(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can link at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _led(entries: DataFrame, number: int, percent: int) -> DataFrame:
    """(u, v): for each entry of a list whose classes are not all in one component, a pair with a leader of the list."""
    rank = F.xxhash64("cls", F.lit(number))
    lists = entries.groupBy("h").agg(
        F.min_by(F.struct("cls", "n", "comp"), rank).alias("leader"), F.min("comp").alias("low"), F.max("comp").alias("high")
    )
    lists = lists.where("low <> high").select("h", "leader")
    led = entries.join(lists, "h").where((F.col("comp") != F.col("leader.comp")) & _alike(F.col("n"), F.col("leader.n"), percent))
    return led.select(F.greatest("cls", "leader.cls").alias("u"), F.least("cls", "leader.cls").alias("v")).distinct()


def _occurring(entries: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """(u, v): all pairs of classes in different components that occur together in enough short lists.

    The member of the smaller component is looked for, the other looks; of equal ones the smaller number. So the entries of a list's largest
    component are in no chunk, and a pair meets in the lists of one of its classes alone. `bits` are (cls, bits).
    """
    sizes = entries.select("cls", "comp").distinct().groupBy("comp").agg(F.count("*").alias("members"))
    entries = entries.join(sizes, "comp").withColumn("rank", F.struct("members", "comp"))
    lists = entries.groupBy("h").agg(F.min("rank").alias("low"), F.max("rank").alias("high"))
    lists = lists.where(F.col("low") < F.col("high"))
    entries = entries.join(lists, "h").drop("members").join(bits, "cls")
    found = stored(entries, "overlap-lists")
    sought = found.where(F.col("rank") < F.col("high"))
    longest = sought.groupBy("h").count().agg(F.max("count")).first()[0] or 0
    parts = -(-longest // CHUNK)
    part = F.pmod(F.xxhash64("cls"), F.lit(max(1, parts)))
    entry = F.struct("cls", "n", F.col("rank.members").alias("members"), "comp", "bits")

    def chunked(rows: DataFrame, name: str) -> DataFrame:
        return rows.withColumn(f"{name}_part", part).groupBy("h", f"{name}_part").agg(F.collect_list(entry).alias(name))

    # a list by itself, chunk against chunk
    tiles = chunked(found.where(F.col("rank") > F.col("low")), "asking").join(chunked(sought, "held"), "h")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What each entry of a list finds there: the list in order, cut down to what can link."""
        for batch in batches:
            asking, held, parts = (batch.column(c) for c in ("asking", "held", "held_part"))
            for i in range(batch.num_rows):
                x, y = asking[i].values, held[i].values
                y = y.take(pa.array(np.argsort(y.field("cls").to_numpy())))
                by, of = asked_for(x, y, percent)
                queries, starts = np.unique(by, return_index=True)
                if not len(by):
                    continue
                offsets = pa.array(np.append(starts, len(by)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, y.field(c).take(pa.array(of))) for c in ("cls", "n")]
                of_query = [x.field(c).take(pa.array(queries)) for c in ("cls", "n")]
                part_of = pa.array(np.full(len(queries), parts[i].as_py(), np.int64))
                yield pa.record_batch([*of_query, part_of, *lists], names=["u", "size", "part", "list", "sizes"])

    asked = tiles.select("asking", "held", "held_part").mapInArrow(ask, "u long, size long, part long, list array<long>, sizes array<long>")
    asked = asked.repartition("u", "part").sortWithinPartitions("u", "part")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Merge the lists of each query by a heap and count how often a class comes."""
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("u", "part", "size", "list", "sizes"))))
        u, v = [], []
        for (query, _, size), lists in groupby(rows, key=lambda r: r[:3]):
            heads = [zip(row[3], row[4]) for row in lists]
            for (cls, n), times in groupby(heapq.merge(*heads)):
                if sum(1 for _ in times) >= min(SHARED, _own_overlap(min(size, n), percent)):
                    u.append(max(query, cls))
                    v.append(min(query, cls))
            if len(u) >= 100_000:
                yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
                u, v = [], []
        yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return asked.mapInArrow(merged, "u long, v long")


def _in_components(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """`entries` with the component of each class; `roots` are (u, v) as `components` gives them."""
    found = entries.join(roots.select(F.col("u").alias("cls"), "v"), "cls", "left")
    return found.select("h", "cls", "n", F.coalesce("v", "cls").alias("comp"))


def overlap_links(classes: DataFrame, rows: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(u, v): links between classes that connect all that are linked."""
    entries = stored(_short_lists(classes, percent), "overlap-short-lists")
    wanted = entries.select("cls").distinct().join(classes.select("cls", "key", "least"), "cls")
    sets = stored(_sets(rows, stored(wanted, "overlap-wanted"), width), "overlap-sets")
    placed, links = entries.withColumn("comp", F.col("cls")), None
    for number in range(LEADER_ROUNDS):
        found = _linked(_led(placed, number, percent), sets, percent)
        links = stored(found if links is None else links.unionByName(found), "overlap-links")
        links = components(links)
        placed = stored(_in_components(entries, links), "overlap-placed")
    pairs = stored(_occurring(placed, classes.select("cls", "bits"), percent), "overlap-pairs")
    return links.unionByName(_linked(pairs, sets, percent))


def overlap_join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows = texts(docs)
    base = stored(_posted(rows, frequent_shingles(rows, width), width, percent), "overlap-base")
    filled = base.where("n > 0")
    classes = filled.groupBy("key").agg(
        F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("counted").alias("counted"), F.first("more").alias("more")
    )
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "overlap-classes")
    roots = components(overlap_links(classes, rows, width, percent))
    placed = classes.select("cls", "key", "least").join(roots.select(F.col("u").alias("cls"), "v"), "cls", "left")
    placed = placed.withColumn("root", F.coalesce("v", "cls"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = placed.join(least, "root").select("key", "component_id")
    found = filled.select("doc_id", "n", "key").join(of_class, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = base.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionByName(empty)
