"""Operator 1: token ids in Arrow stream files of equal-length sequences and masks.

A file is an Arrow IPC stream whose record batches all hold the same number of rows (the last may hold fewer) of

    input_ids       fixed_size_list<uint16 or uint32>[length]
    attention_mask  fixed_size_list<uint8>[length]      1: a token, 0: padding

so that sequence i is row i % rows of batch i // rows, at a fixed place. Mapped into memory, it is read without a copy. A
second stream `<file>.index` holds (doc_id, start, n_tokens) of its documents, start counting ids within the file. Files hold
whole documents; only the last sequence of a file is padded. A file is closed once it has FILE_TOKENS ids, so its size is bounded
but for a single larger document.

Documents are ordered by range partitioning on (doc_id, row number), so that equal or null ids spread over tasks; each task
encodes, cuts and writes as it goes, holding one batch. Only files named in the manifest, a written table, count: those of failed
attempts have other names and are never read. The positions of files follow from their sizes.

Null texts are empty: a document of the end id alone. Null ids come first. Equal ids keep separate rows, in any order. An empty
table gives no file. Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyrill.llm import files
from keyrill.llm.common import return_freed_memory, slices, spread, stored, texts
from keyrill.llm.tokenizing import load, token_ids

FILE_TOKENS = 16_000_000
ROWS_PER_BATCH = 256
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Writes one file and its index; ids are given document by document."""

    def __init__(self, path: str, length: int, wide: bool, rows: int = ROWS_PER_BATCH) -> None:
        self.path, self.length, self.rows = path, length, rows
        self.kind = np.dtype("<u4") if wide else np.dtype("<u2")
        self.schema = pa.schema(
            [
                ("input_ids", pa.list_(pa.uint32() if wide else pa.uint16(), length)),
                ("attention_mask", pa.list_(pa.uint8(), length)),
            ]
        )
        self.sink = files.create(path)
        self.stream = pa.ipc.new_stream(self.sink, self.schema)
        self.pending: list[np.ndarray] = []
        self.waiting = self.tokens = 0
        self.documents: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append((doc_id, self.tokens, len(ids)))
        self.pending.append(ids.astype(self.kind))
        self.waiting += len(ids)
        self.tokens += len(ids)
        if self.waiting >= self.length * self.rows:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, self.kind)
        per_batch = self.length * self.rows
        whole = len(ids) if last else len(ids) // per_batch * per_batch
        for start in range(0, whole, per_batch):
            part = ids[start : min(start + per_batch, whole)]
            mask = np.zeros(-(-len(part) // self.length) * self.length, np.uint8)
            mask[: len(part)] = 1
            part = np.concatenate([part, np.zeros(len(mask) - len(part), self.kind)])
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (part, mask)]
            self.stream.write_batch(pa.record_batch(columns, schema=self.schema))
        self.pending = [ids[whole:]]
        self.waiting = len(ids) - whole

    def close(self) -> tuple[str, int, int]:
        """(path, documents, ids) once all is on disk."""
        self._flush(last=True)
        self.stream.close()
        self.sink.close()
        with files.create(f"{self.path}.index") as sink, pa.ipc.new_stream(sink, _INDEX) as stream:
            columns = zip(*self.documents) if self.documents else ([], [], [])
            stream.write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=_INDEX))
        return self.path, len(self.documents), self.tokens


class SequenceFile:
    """Random access to a file's sequences, masks and documents; arrays are views of the mapped file."""

    def __init__(self, path: str) -> None:
        self.source = files.contents(path)
        stream = pa.ipc.open_stream(self.source)
        self.length = stream.schema.field("input_ids").type.list_size
        batches = list(stream)
        self.ids = [b.column("input_ids").flatten().to_numpy().reshape(-1, self.length) for b in batches]
        self.masks = [b.column("attention_mask").flatten().to_numpy().reshape(-1, self.length) for b in batches]
        self.rows = len(self.ids[0]) if self.ids else 1
        self.index = pa.ipc.open_stream(files.contents(f"{path}.index")).read_all()

    def __len__(self) -> int:
        return sum(map(len, self.ids))

    def __getitem__(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        batch, row = divmod(number, self.rows)
        return self.ids[batch][row], self.masks[batch][row]

    def tokens(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from `start` on, as consecutive views of batches."""
        per_batch = self.rows * self.length
        while count:
            batch, at = divmod(start, per_batch)
            part = self.ids[batch].reshape(-1)[at : at + count]
            yield part
            start, count = start + len(part), count - len(part)


@dataclass(frozen=True)
class Encoding:
    """Which ids documents are written as."""

    tokenizer: str
    end_id: int | None = 2
    length: int = 1024
    file_tokens: int = FILE_TOKENS


def write_sequences(docs: DataFrame, folder: str, encoding: Encoding) -> DataFrame:
    """Write all documents below `folder` in ascending order of doc_id.

    Returns the manifest (file, documents, tokens, before), `before` being the ids in the files before it.
    """
    wide = load(encoding.tokenizer).get_vocab_size(with_added_tokens=True) > 1 << 16

    def write(batches):
        encoder, task = token_ids(encoding.tokenizer), TaskContext.get().partitionId()
        end = np.array([] if encoding.end_id is None else [encoding.end_id], "<u4")
        writer, number = None, 0

        def closed():
            path, documents, tokens = writer.close()
            return pa.record_batch([[task], [number], [path], [documents], [tokens]], names=["task", "number", "file", "documents", "tokens"])

        for batch in batches:
            for part in slices(batch):
                ids, edges = encoder.encode_column(part.column("text"))
                for doc_id, low, high in zip(part.column("doc_id").to_pylist(), edges[:-1].tolist(), edges[1:].tolist()):
                    if writer is None:
                        path = f"{folder}/{task:06d}-{number:04d}-{uuid.uuid4().hex[:8]}.arrows"
                        writer = SequenceWriter(path, encoding.length, wide)
                    writer.add(doc_id, np.concatenate([ids[low:high], end]))
                    if writer.tokens >= encoding.file_tokens:
                        yield closed()
                        writer, number = None, number + 1
                return_freed_memory()
        if writer is not None:
            yield closed()

    ordered = texts(docs).withColumn("row", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    written = ordered.mapInArrow(write, "task long, number long, file string, documents long, tokens long")
    manifest = stored(written, "sequences-manifest")
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select("file", "documents", "tokens", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files that the manifest names.

    ids_crc32 is that of the ids as little-endian unsigned 32-bit integers, found view by view.
    """

    def read(batches):
        for batch in batches:
            for path, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
                file = SequenceFile(path)
                for part in file.index.to_batches(max_chunksize=50_000):
                    starts, counts = (part.column(c).to_numpy() for c in ("start", "n_tokens"))
                    sums = np.zeros(len(starts), np.int64)
                    for i, (start, count) in enumerate(zip(starts.tolist(), counts.tolist())):
                        found = 0
                        for view in file.tokens(start, count):
                            found = zlib.crc32(view.astype("<u4"), found)
                        sums[i] = found
                    columns = [part.column("doc_id"), pa.array(starts + before), pa.array(counts), pa.array(sums)]
                    yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = spread(manifest.select("file", "before"), "file", manifest.count())
    return rows.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_sequences(manifest: DataFrame) -> DataFrame:
    """(file, number, input_ids, attention_mask) of every sequence."""

    def read(batches):
        for batch in batches:
            for path in batch.column("file").to_pylist():
                numbered = 0
                for found in pa.ipc.open_stream(files.contents(path)):
                    rows = found.num_rows
                    ids, mask = (found.column(c).cast(pa.list_(pa.int32())) for c in ("input_ids", "attention_mask"))
                    numbers = pa.array(range(numbered, numbered + rows), pa.int64())
                    yield pa.record_batch([pa.array([path] * rows), numbers, ids, mask], names=["file", "number", "input_ids", "attention_mask"])
                    numbered += rows

    schema = "file string, number long, input_ids array<int>, attention_mask array<int>"
    return spread(manifest.select("file"), "file", manifest.count()).mapInArrow(read, schema)
