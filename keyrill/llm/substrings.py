"""Operator 6: repeated substrings, found from fixed-block anchors.

A window of `width` words is removed wherever its words also start earlier. Whatever repeats over `width` words contains, in the
earlier copy, a whole block of width / 2 words at a position divisible by width / 2. So these non-overlapping blocks are
indexed, every rolling window of width / 2 words probes the index, and only windows around hits are looked at further: hits are extended
to full windows, whose earliest place is found; runs of windows that start earlier elsewhere are the maximal repeats.

How the work is dealt. Documents in order of (doc_id, row number) are cut into files of a few megabytes in the shared folder. A file is
hashed as a whole, and sends each bucket of hash values one row with its distinct hashes, packed; so a passage that a third of all
documents share counts once a file. Buckets answer with one bit a hash. Files are read three times: to probe, to extend, to cut. The
number of buckets follows the number of words, and memory is one file or one bucket. Probes keep 32 bits beside the bucket's; a
false hit only costs work. Full windows are compared by two independent 64-bit hashes of all their words.

Null texts have no words. Null ids come before all others. Rows of equal ids are documents of their own, in any order among them.
An empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keyrill.llm import files
from keyrill.llm.common import return_freed_memory, spread, stored, string_buffer
from keyrill.llm.words import Hasher, inside, scan
from keyrill.streaming.jobs import work_folder

WIDTH = 20
FILE_BYTES = 4_000_000
WORDS_PER_BUCKET = 2_000_000

_hashers: list[Hasher] = []


def _two_hashers() -> list[Hasher]:
    if not _hashers:
        _hashers.extend((Hasher(61), Hasher(62)))
    return _hashers


def _file_documents(docs: DataFrame, folder: str, file_bytes: int) -> DataFrame:
    """Write the rows of `docs` (text first, then c1, c2, ...) in order; (file, path, words), file numbers rising with the order."""

    def write(batches):
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def written():
            nonlocal number, held, size
            table = pa.Table.from_batches(held).combine_chunks()
            path = f"{folder}/{task:06d}-{number:05d}-{uuid.uuid4().hex[:8]}.arrow"
            with files.create(path) as sink, pa.ipc.new_file(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
            words = sum(len(scan(*string_buffer(chunk))[0]) for chunk in table.column("text").chunks)
            row = pa.record_batch([[task << 32 | number], [path], [words]], names=["file", "path", "words"])
            number, held, size = number + 1, [], 0
            return row

        for batch in batches:
            lengths = np.diff(string_buffer(batch.column("text"))[1])
            start = 0
            for i, length in enumerate(lengths.tolist()):
                if size and size + length > file_bytes:
                    held.append(batch.slice(start, i - start))
                    start = i
                    yield written()
                size += length + 16
            held.append(batch.slice(start))
        if size:
            yield written()

    ordered = docs.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("c1", "row")
    ordered = ordered.sortWithinPartitions("c1", "row").select("text", *docs.columns[1:])
    return stored(ordered.mapInArrow(write, "file long, path string, words long"), "substring-files")


class _File:
    """The documents of one file and the hashes of their words."""

    def __init__(self, path: str, width: int) -> None:
        return_freed_memory()
        self.table = pa.ipc.open_file(files.contents(path)).read_all().combine_chunks()
        self.width = width
        column = self.table.column("text")
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
        self.data, offsets = string_buffer(column)
        self.starts, self.ends, self.first = scan(self.data, offsets)
        self.count = len(self.starts)
        self.words = _two_hashers()[0].words(self.data, self.starts, self.ends)

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of all rolling windows of half the width, in order of their hashes; the hashes; where a new one begins."""
        half = self.width // 2
        hashes = _two_hashers()[0].windows(self.words, half)
        places = np.flatnonzero(inside(self.first, self.count, half)[: len(hashes)])
        hashes = hashes[places]
        order = np.argsort(hashes)
        hashes = hashes[order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        return places[order], hashes, new

    def aligned(self, places: np.ndarray) -> np.ndarray:
        """Which places are those of indexed blocks."""
        text = np.searchsorted(self.first, places, side="right") - 1
        return (places - self.first[text]) % (self.width // 2) == 0

    def candidates(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Full windows around hits: their places in order of both hashes, the hashes, and where a new one begins.

        bits: for each distinct probe in order, whether it hit.
        """
        places, _, new = self.probes()
        hit = np.zeros(self.count + 1, np.int64)
        hit[places[bits[np.cumsum(new) - 1]]] = 1
        sums = np.concatenate([[0], np.cumsum(hit)])
        whole = np.flatnonzero(inside(self.first, self.count, self.width))
        half = self.width // 2
        whole = whole[sums[whole + half] > sums[whole]]  # an indexed block starts at one of the first places of the window
        if not len(whole):
            return whole, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool)
        second = _two_hashers()[1]
        a = _two_hashers()[0].windows(self.words, self.width)[whole]
        b = second.windows(second.words(self.data, self.starts, self.ends), self.width)[whole]
        order = np.lexsort((whole, b, a))
        whole, a, b = whole[order], a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return whole, a, b, new

    def repeated(self, places: np.ndarray, new: np.ndarray, elsewhere: np.ndarray) -> np.ndarray:
        """Which words are covered by a window that starts earlier too. elsewhere: for each distinct window, in an earlier file."""
        window = np.zeros(self.count + 1, np.int64)
        late = ~new | elsewhere[np.cumsum(new) - 1] if len(new) else new
        window[places[late]] = 1
        sums = np.cumsum(window)
        sums[self.width :] -= sums[: -self.width].copy()
        return sums[: self.count] > 0


def _bucket_edges(sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
    buckets = np.arange(1 << bits, dtype=np.uint64)
    edges = np.searchsorted(sorted_hashes, buckets << np.uint64(64 - bits))
    return np.append(edges, len(sorted_hashes))


def _packed(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _unpacked(packed, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=count).astype(bool)


def _sent_probes(manifest: DataFrame, width: int, bits: int, count: int) -> DataFrame:
    def send(batches):
        for batch in batches:
            for number, path in zip(batch.column("file").to_pylist(), batch.column("path").to_pylist()):
                file = _File(path, width)
                places, hashes, new = file.probes()
                at = np.flatnonzero(new)
                if not len(at):
                    continue
                many = np.diff(np.append(at, len(new))) > 1
                aligned = np.logical_or.reduceat(file.aligned(places), at)
                hashes = hashes[at]
                kept = ((hashes << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
                edges = _bucket_edges(hashes, bits).tolist()
                spans = [(k, s, e) for k, (s, e) in enumerate(zip(edges, edges[1:])) if e > s]
                yield pa.record_batch(
                    [
                        pa.array([k for k, _, _ in spans], pa.int32()),
                        pa.array([number] * len(spans), pa.int64()),
                        pa.array([kept[s:e].tobytes() for _, s, e in spans], pa.binary()),
                        pa.array([_packed(many[s:e]) for _, s, e in spans], pa.binary()),
                        pa.array([_packed(aligned[s:e]) for _, s, e in spans], pa.binary()),
                    ],
                    names=["bucket", "file", "hashes", "many", "aligned"],
                )

    schema = "bucket int, file long, hashes binary, many binary, aligned binary"
    return spread(manifest.select("file", "path"), "file", count).mapInArrow(send, schema)


def _answers(table: pa.Table, flags: np.ndarray, counts: list[int]) -> pa.Table:
    stops = np.cumsum(counts)[:-1]
    packed = pa.array([_packed(part) for part in np.split(flags, stops)], pa.binary())
    sizes = pa.array(counts, pa.int32())
    return pa.table([table.column("bucket"), table.column("file"), sizes, packed], names=["bucket", "file", "size", "bits"])


def _probe_answers(table: pa.Table) -> pa.Table:
    """A probe hits if its words are at two places at least, one of them an indexed block's."""
    return_freed_memory()
    hashes = [np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("hashes")]
    counts = [len(x) for x in hashes]
    many, aligned = (np.concatenate([_unpacked(x.as_buffer(), n) for x, n in zip(table.column(c), counts)]) for c in ("many", "aligned"))
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(new)
    hit = (np.diff(np.append(at, len(new))) > 1) | np.logical_or.reduceat(many[order], at)
    hit &= np.logical_or.reduceat(aligned[order], at)
    flags = np.empty(len(hashes), bool)
    flags[order] = hit[np.cumsum(new) - 1]
    return _answers(table, flags, counts)


def _sent_windows(asked: DataFrame, width: int, bits: int) -> DataFrame:
    def send(batches):
        for number, file, answers in _opened(batches, width):
            _, a, b, new = file.candidates(answers[0])
            a, b = a[new], b[new]
            edges = _bucket_edges(a, bits).tolist()
            spans = [(k, s, e) for k, (s, e) in enumerate(zip(edges, edges[1:])) if e > s]
            yield pa.record_batch(
                [
                    pa.array([k for k, _, _ in spans], pa.int32()),
                    pa.array([number] * len(spans), pa.int64()),
                    pa.array([a[s:e].tobytes() for _, s, e in spans], pa.binary()),
                    pa.array([b[s:e].tobytes() for _, s, e in spans], pa.binary()),
                ],
                names=["bucket", "file", "a", "b"],
            )

    return asked.mapInArrow(send, "bucket int, file long, a binary, b binary")


def _window_answers(table: pa.Table) -> pa.Table:
    """A window is late in all files but the first that has it."""
    return_freed_memory()
    parts = [[np.frombuffer(x.as_buffer(), np.uint64) for x in table.column(c)] for c in ("a", "b")]
    counts = [len(x) for x in parts[0]]
    a, b = (np.concatenate(x) for x in parts)
    file = np.repeat(table.column("file").to_numpy(), counts)
    order = np.lexsort((file, b, a))
    late = np.zeros(len(a), bool)
    late[order[1:]] = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
    return _answers(table, late, counts)


def _opened(batches, width: int) -> Iterator[tuple[int, _File, list[np.ndarray]]]:
    """Each file with the bits of its answers, joined in order of buckets."""
    for batch in batches:
        names = [n for n in batch.schema.names if n.startswith("answers")]
        for i in range(batch.num_rows):
            answers = []
            for name in names:
                rows = sorted(batch.column(name)[i].as_py() or (), key=lambda r: r["bucket"])
                parts = [_unpacked(r["bits"], r["size"]) for r in rows]
                answers.append(np.concatenate(parts) if parts else np.zeros(0, bool))
            yield batch.column("file")[i].as_py(), _File(batch.column("path")[i].as_py(), width), answers


def _gathered(answers: DataFrame, name: str) -> DataFrame:
    """One row a file; it holds a bit for each of the file's hashes."""
    return answers.groupBy("file").agg(F.collect_list(F.struct("bucket", "size", "bits")).alias(name))


def repeated_spans(
    docs: DataFrame, width: int = WIDTH, joined: bool = False, file_bytes: int = FILE_BYTES, words_per_bucket: int = WORDS_PER_BUCKET
) -> DataFrame:
    """(document, n_words, n_removed, spans) of every row of `docs`, `document` being a struct of its columns.

    The document's text is what is left: all of it where nothing is removed, else the other words joined by one space (`joined`:
    in either case the words so joined). spans: the maximal runs of removed words, as (start, end) numbers of words.
    """
    if width < 2 or width % 2:
        raise ValueError("width must be even")
    spark = docs.sparkSession
    others = [c for c in docs.columns if c not in ("text", "doc_id")]
    names = {"doc_id": "c1"} | {c: f"c{i}" for i, c in enumerate(others, 2)}
    plain = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), *(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    manifest = _file_documents(plain, work_folder(spark, "substrings"), file_bytes)
    count, words = manifest.agg(F.count("*"), F.coalesce(F.sum("words"), F.lit(0))).first()
    bits = max(4, math.ceil(math.log2(max(1, words / words_per_bucket))))

    answer = "bucket int, file long, size int, bits binary"
    probes = _sent_probes(manifest, width, bits, count).groupBy("bucket").applyInArrow(_probe_answers, answer)
    probes = stored(_gathered(probes, "answers1"), "substring-probes")
    asked = spread(manifest.join(probes, "file").select("file", "path", "answers1"), "file", count)
    windows = _sent_windows(asked, width, bits).groupBy("bucket").applyInArrow(_window_answers, answer)
    windows = stored(_gathered(windows, "answers2"), "substring-windows")
    known = manifest.join(probes, "file", "left").join(windows, "file", "left").select("file", "path", "answers1", "answers2")
    known = spread(known, "file", count)
    result = StructType.fromDDL("text string, n_words long, n_removed long, spans array<struct<start: long, end: long>>")
    for field in plain.schema.fields[1:]:
        result.add(field.name, field.dataType)

    def cut(batches):
        for _, file, (hits, late) in _opened(batches, width):
            places, _, _, new = file.candidates(hits)
            gone = file.repeated(places, new, late)
            sums = np.concatenate([[0], np.cumsum(gone)])
            removed = np.diff(sums[file.first])
            for start in range(0, len(removed), 1000):
                rows = file.table.slice(start, 1000)
                kept, spans = [], []
                for i, text in enumerate(rows.column("text").to_pylist(), start):
                    low, high = file.first[i], file.first[i + 1]
                    if removed[i] or joined:
                        mask = gone[low:high]
                        all_words = text.encode().split()
                        text = b" ".join(compress(all_words, (~mask).tolist()) if removed[i] else all_words).decode()
                        turns = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))).tolist()
                        spans.append([{"start": s, "end": e} for s, e in zip(turns[::2], turns[1::2])])
                    else:
                        spans.append([])
                    kept.append(text)
                n = slice(start, start + 1000)
                columns = [
                    pa.array(kept, pa.string()),
                    pa.array(np.diff(file.first)[n], pa.int64()),
                    pa.array(removed[n], pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    *(rows.column(c).combine_chunks() for c in rows.column_names[1:]),
                ]
                yield from pa.Table.from_arrays(columns, names=result.names).to_batches()

    found = known.mapInArrow(cut, result)
    columns = [F.col("text").alias(c) if c == "text" else F.col(names[c]).alias(c) for c in docs.columns]
    return found.select(F.struct(*columns).alias("document"), "n_words", "n_removed", "spans")


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of `docs`, all columns, with repeated words cut from the text and n_chars, if there, counted anew where any were."""
    found = repeated_spans(docs, width)
    n_chars = F.when(F.col("n_removed") > 0, F.length("document.text")).otherwise(F.col("document.n_chars")) if "n_chars" in docs.columns else None
    return found.select(*(n_chars.cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"document.`{c}`") for c in docs.columns))
