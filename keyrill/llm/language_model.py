"""Operator 10: log probabilities of whole texts under a causal self-attention model on subword ids.

Words are cut into the subword ids of a public tokenizer, an end id follows each text. The corpus gives, over all texts that are learned
from, the count of every word, of every subword id, and of what stands near each id. Ids fall into CLASSES classes: the most frequent
ones alone, the others by what stands near them. The attention model, trained on every place of every text that is learned from,
predicts the class from what went before; an id has its share of its class by the counts of the whole corpus, plus one. A word's
probability is the mean of that of its ids and of its own share of all words (the base), so neither unknown words nor frequent ones are lost.

How the work is dealt. Texts are encoded once, in files of a few megabytes in the shared folder: distinct words with their hashes and ids,
and the order of words as numbers. A file sends each bucket of hashes one packed row and gets the counts of its words back in the
same order; a word that is everywhere counts once a file. Training goes through each file once, in rounds: first the files of about
FIRST_RUNS runs of RUN_TOKENS ids, one after the other, then in each round about GROWTH times as many as so far, side by side from the model of
the round before, and the mean of the models that come out is the next. A small corpus is one round, gone through as often as gives STEPS steps. Then each file is scored by itself. The
driver sees the counts of the tokenizer's ids and of their neighbours and the model, all bounded. Words are told apart by 64-bit hashes.

Null texts are empty: one end. Null ids are neither learned from nor held out. Equal ids and repeated rows keep their rows. With
nothing to learn from, the base is 0 and the score follows from an untrained model. Other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyrill.llm import files
from keyrill.llm.attention import Attention, begun, fitted, packed, unpacked
from keyrill.llm.common import held, remainder, slices, spread, stored, string_buffer
from keyrill.llm.tokenizing import TokenIds, load
from keyrill.llm.words import Hasher, scan
from keyrill.streaming.jobs import work_folder

CLASSES = 80
ALONE = 48
_NEAR = 6
FIRST_RUNS = 2
RUN_TOKENS = 1_400_000
GROWTH = 4
STEPS = 900
RATE = 0.006
LEAST_RATE = 0.001
_QUANTUM = 1 << 20
_NEAR_FILES = 16
_NEAR_TASKS = 1000
_NEAR_BLOCK = 128
_SLOT_BITS = 21
_SLOT_IDS = 8
_EMPTY = 255
_TOKEN_BYTES = 8_000_000
FILE_BYTES = 4_000_000
WORDS_PER_BUCKET = 2_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ARRAYS = {"ids": "<u4", "id_first": "<i8", "hashes": "<u8", "learned": "<u4", "order": "<u4", "first": "<i8", "held_out": "?"}


class WordIds:
    """The ids of words, found by hash. A slot of the table keeps the last word of few ids that fell into it (86 MB in all)."""

    def __init__(self, tokenizer: str) -> None:
        self.hasher = Hasher(101)
        self.encoder = TokenIds(tokenizer, _TOKEN_BYTES)
        self.hashes = np.zeros(1 << _SLOT_BITS, np.uint64)
        self.sizes = np.full(1 << _SLOT_BITS, _EMPTY, np.uint8)
        self.ids = np.zeros((1 << _SLOT_BITS, _SLOT_IDS), np.uint32)

    def __call__(self, hashes: np.ndarray, words) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after the other, and where each word's begin; `words` gives the text of those at some places."""
        slots = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        known = (self.hashes[slots] == hashes) & (self.sizes[slots] != _EMPTY)
        old, new = np.flatnonzero(known), np.flatnonzero(~known)
        fresh, fresh_first = self.encoder.encode_words(words(new))
        sizes = np.empty(len(hashes), np.int64)
        sizes[old], sizes[new] = self.sizes[slots[old]], np.diff(fresh_first)
        first = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.empty(first[-1], np.uint32)
        ids[np.repeat(first[new] - fresh_first[:-1], sizes[new]) + np.arange(len(fresh))] = fresh
        used = np.arange(_SLOT_IDS) < sizes[old, None]
        ids[(first[old, None] + np.arange(_SLOT_IDS))[used]] = self.ids[slots[old]][used]
        # two words of one slot: the last one stays, whole
        short = np.flatnonzero(sizes[new] <= _SLOT_IDS)
        short = short[np.append(slots[new[short]][1:] != slots[new[short]][:-1], True)] if len(short) else short
        at, used = slots[new[short]], np.arange(_SLOT_IDS) < sizes[new[short], None]
        rows = np.zeros((len(short), _SLOT_IDS), np.uint32)
        rows[used] = fresh[(fresh_first[short, None] + np.arange(_SLOT_IDS))[used]]
        self.hashes[at], self.sizes[at], self.ids[at] = hashes[new[short]], sizes[new[short]], rows
        return ids, first


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As np.unique with the first place of each and the number of each, but only the distinct ones are sorted."""
    found = pa.array(hashes).dictionary_encode()
    values, codes = found.dictionary.to_numpy(), found.indices.to_numpy()
    places, order = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1)), np.argsort(values)
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    return values[order], places[order], rank[codes]


def _encoded(batch: pa.RecordBatch, tokenizer: str) -> dict[str, np.ndarray]:
    """The words of a batch of texts: distinct ones, their ids, and the order they come in."""
    word_ids = held("word ids", tokenizer, lambda: WordIds(tokenizer))
    data, offsets = string_buffer(batch.column("text"))
    data = _LOWER[data]
    starts, ends, first = scan(data, offsets)
    hashes = word_ids.hasher.words(data, starts, ends)
    distinct, one, order = _distinct(hashes)

    def words(places: np.ndarray) -> list[str]:
        begins, sizes = starts[one[places]], ends[one[places]] - starts[one[places]] + 1
        stops = np.cumsum(sizes)
        joined = np.take(data, np.repeat(begins - (stops - sizes), sizes) + np.arange(stops[-1] if len(stops) else 0), mode="clip")
        joined[stops - 1] = ord(" ")
        return joined.tobytes().decode().split(" ")[:-1]

    ids, id_first = word_ids(distinct, words)
    learns = np.array(batch.column("learned").to_pylist(), bool)
    learned = np.bincount(order, np.repeat(learns, np.diff(first)), len(distinct))
    return {
        "ids": ids,
        "id_first": id_first,
        "hashes": distinct,
        "learned": learned,
        "order": order,
        "first": first,
        "held_out": np.array(batch.column("held_out").to_pylist(), bool),
    }


def _save(path: str, arrays: dict[str, np.ndarray], doc_id: pa.Array) -> None:
    parts = [pa.array([arrays[name].astype(kind).tobytes()], pa.large_binary()) for name, kind in _ARRAYS.items()]
    row = pa.record_batch([*parts, pa.array([doc_id.to_pylist()], pa.large_list(pa.int64()))], names=[*_ARRAYS, "doc_id"])
    with files.create(path) as sink, pa.ipc.new_file(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(row)


def _load(path: str, *names: str) -> dict[str, np.ndarray]:
    """Some of the arrays of a file; "doc_id" is an Arrow array."""
    source, every = files.contents(path), [*_ARRAYS, "doc_id"]
    row = pa.ipc.open_file(source, options=pa.ipc.IpcReadOptions(included_fields=[every.index(name) for name in names])).get_batch(0)
    return {name: np.frombuffer(row.column(name)[0].as_buffer(), _ARRAYS[name]) if name in _ARRAYS else row.column(name).flatten() for name in names}


def _encode_files(rows: DataFrame, tokenizer: str, folder: str, file_bytes: int, size: int) -> DataFrame:
    """(file, path, distinct, texts, ids) of each file; in a task's last row the counts of ids, of `size` in all, of the texts learned from."""

    def write(batches):
        task, number, row, counts = TaskContext.get().partitionId(), 0, None, np.zeros(size)
        names = ["file", "path", "distinct", "texts", "ids"]
        for batch in batches:
            for part in slices(batch, most=file_bytes):
                arrays = _encoded(part, tokenizer)
                path = f"{folder}/{task:06d}-{number:05d}-{uuid.uuid4().hex[:8]}.arrow"
                _save(path, arrays, part.column("doc_id"))
                counts += np.bincount(arrays["ids"], np.repeat(arrays["learned"], np.diff(arrays["id_first"])), size)
                if row:
                    yield pa.record_batch([*row, pa.array([None], pa.binary())], names=names)
                texts = sum(part.column("learned").to_pylist())
                row = [pa.array(c) for c in ([task << 32 | number], [path], [len(arrays["hashes"])], [texts])]
                number += 1
        if row:
            yield pa.record_batch([*row, pa.array([counts.astype("<i8").tobytes()], pa.binary())], names=names)

    return stored(rows.mapInArrow(write, "file long, path string, distinct long, texts long, ids binary"), "lm-files")


def _id_counts(manifest: DataFrame, size: int) -> DataFrame:
    """(id, n) over all texts that are learned from; a row an id and task before they are added up."""

    def add(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for counts in batch.column("ids"):
                total += np.frombuffer(counts.as_buffer(), "<i8")
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["id", "n"])

    return manifest.where(F.col("ids").isNotNull()).select("ids").mapInArrow(add, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _with_ends(file: dict[str, np.ndarray], end_id: int, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """The ids of a file's distinct words and of one more, the end; where they begin; and the words of texts, each closed by the end."""
    ids = np.append(file["ids"], end_id).astype(np.int64)
    id_first = np.append(file["id_first"], len(ids))
    return ids, id_first, np.insert(words.astype(np.int64), first[1:], len(id_first) - 2), first + np.arange(len(first))


def _sequence(ids: np.ndarray, id_first: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words, one after the other, and where each word's begin."""
    sizes = np.diff(id_first)[words]
    first = np.concatenate([[0], np.cumsum(sizes)])
    return ids[np.repeat(id_first[:-1][words] - first[:-1], sizes) + np.arange(first[-1])], first


def _learned_ids(path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the texts of a file that are learned from, each with its end, and where each text's begin."""
    file = _load(path, "ids", "id_first", "order", "first", "held_out", "doc_id")
    learned, n = file["doc_id"].is_valid().to_numpy(zero_copy_only=False) & ~file["held_out"], np.diff(file["first"])
    words, first = file["order"][np.repeat(learned, n)], np.concatenate([[0], np.cumsum(n[learned])])
    *distinct, words, first = _with_ends(file, end_id, words, first)
    ids, begins = _sequence(*distinct, words)
    return ids, begins[first]


def _near_counts(manifest: DataFrame, alone: np.ndarray, end_id: int, count: int) -> DataFrame:
    """(block, near): of _NEAR_BLOCK ids each, how often each of the ids `alone` stands near them in the texts learned from, packed."""
    size = end_id + 1
    column = np.full(size + 1, -1, np.int32)
    column[alone] = np.arange(len(alone))
    # ids that stand alone themselves, and places outside the text, are counted in a row that is left out
    row = np.where(column < 0, np.arange(size + 1), size).astype(np.int32) * ALONE

    def count_near(batches):
        total = np.zeros((size + 1) * ALONE, np.int64)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                ids, first = _learned_ids(path, end_id)
                padded = np.full(len(ids) + _NEAR * len(first), size, np.int64)
                padded[np.arange(len(ids)) + np.repeat(np.arange(1, len(first)) * _NEAR, np.diff(first))] = ids
                beside, at = row[padded], np.flatnonzero(column[padded] >= 0)
                own = column[padded[at]]
                gaps = [g for gap in range(1, _NEAR + 1) for g in (-gap, gap)]
                total += np.bincount(np.concatenate([beside[at + gap] + own for gap in gaps]), minlength=len(total))
        blocks = np.split(total[: size * ALONE], range(_NEAR_BLOCK * ALONE, size * ALONE, _NEAR_BLOCK * ALONE))
        packed_blocks = [(k, near.tobytes()) for k, near in enumerate(blocks) if near.any()]
        yield pa.record_batch([pa.array([k for k, _ in packed_blocks], pa.int32()), pa.array([near for _, near in packed_blocks], pa.binary())], names=["block", "near"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(near.as_buffer(), "<i8") for near in rows.column("near"))
        return pa.table([rows.column("block").slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=["block", "near"])

    schema = "block int, near binary"
    tasks = min(-(-count // _NEAR_FILES), _NEAR_TASKS)
    return spread(manifest.select("file", "path"), "file", tasks).mapInArrow(count_near, schema).groupBy("block").applyInArrow(add, schema)


def _trained(manifest: DataFrame, tokens: float, class_of: np.ndarray, network: Attention) -> Attention:
    """The network after every file, in rounds. Models are added up as whole numbers, so that the order of tasks changes nothing."""
    class_of = class_of.astype(np.uint8)
    share, done, rounds = min(1.0, FIRST_RUNS * RUN_TOKENS / tokens), 0.0, 0
    place = F.pmod(F.xxhash64("file"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    while done < 1:
        flat, alone, rate = packed(network), rounds == 0, max(LEAST_RATE, RATE / 2**rounds)

        def run(batches, flat=flat, alone=alone, rate=rate):
            found = sorted(pair for batch in batches for pair in zip(batch.column("file").to_pylist(), batch.column("path").to_pylist()))
            model, parts, held_tokens, learned = unpacked(network, flat), [], 0, 0
            for k, (number, path) in enumerate(found, 1):
                parts.append(_learned_ids(path, len(class_of) - 1))
                held_tokens += len(parts[-1][0])
                if held_tokens >= RUN_TOKENS or k == len(found):
                    before = np.cumsum([0, *(len(ids) for ids, _ in parts)])
                    first = np.concatenate([[0], *(begins[1:] + n for (_, begins), n in zip(parts, before))])
                    model = fitted(model, class_of[np.concatenate([ids for ids, _ in parts])], first, STEPS if alone else 1, rate=rate, seed=number)
                    parts, held_tokens, learned = [], 0, learned + held_tokens
            if learned:
                total = np.rint(packed(model).astype(np.float64) * _QUANTUM).astype(np.int64)
                yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "total"])

        files_of = manifest.where((place >= done) & (place < share)).select("file", "path")
        files_of = files_of.coalesce(1) if alone else spread(files_of, "file", math.ceil(tokens * (share - done) / RUN_TOKENS))
        models = files_of.mapInArrow(run, "place long, total long").groupBy("place").agg(F.sum("total").alias("total"), F.count("*").alias("models")).collect()
        if models:
            flat = np.empty(len(flat), np.float64)
            for r in models:  # one row a parameter
                flat[r["place"]] = r["total"] / (_QUANTUM * r["models"])
            network, rounds = unpacked(network, flat.astype(np.float32)), rounds + 1
        done, share = share, min(1.0, share * (GROWTH + 1))
    return network


def _word_counts(manifest: DataFrame, words_per_bucket: int, count: int) -> DataFrame:
    """(bucket, file, counts, distinct, total): of a file's words in a bucket; of all words of the bucket in one of its rows."""
    distinct = manifest.agg(F.sum("distinct")).first()[0] or 0
    bits = max(4, math.ceil(math.log2(max(1, distinct / words_per_bucket))))

    def send(batches):
        for batch in batches:
            for number, path in zip(batch.column("file").to_pylist(), batch.column("path").to_pylist()):
                arrays = _load(path, "hashes", "learned")
                hashes, learned = arrays["hashes"], arrays["learned"]
                edges = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist() + [len(hashes)]
                spans = [(k, s, e) for k, (s, e) in enumerate(zip(edges, edges[1:])) if e > s]
                yield pa.record_batch(
                    [
                        pa.array([k for k, _, _ in spans], pa.int32()),
                        pa.array([number] * len(spans), pa.int64()),
                        pa.array([hashes[s:e].tobytes() for _, s, e in spans], pa.binary()),
                        pa.array([learned[s:e].tobytes() for _, s, e in spans], pa.binary()),
                    ],
                    names=["bucket", "file", "hashes", "learned"],
                )

    def add(rows: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x.as_buffer(), "<u8") for x in rows.column("hashes")]
        learned = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in rows.column("learned")])
        stops = np.cumsum([len(h) for h in hashes])[:-1]
        distinct, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.bincount(inverse, learned, len(distinct)).astype("<i8")
        known, total = [int((counts > 0).sum())] + [0] * (len(hashes) - 1), [int(counts.sum())] + [0] * (len(hashes) - 1)
        packed = pa.array([part.tobytes() for part in np.split(counts[inverse], stops)], pa.binary())
        return pa.table([rows.column("bucket"), rows.column("file"), packed, pa.array(known, pa.int64()), pa.array(total, pa.int64())], names=["bucket", "file", "counts", "distinct", "total"])

    sent = spread(manifest.select("file", "path"), "file", count).mapInArrow(send, "bucket int, file long, hashes binary, learned binary")
    return stored(sent.groupBy("bucket").applyInArrow(add, "bucket int, file long, counts binary, distinct long, total long"), "lm-counts")


@dataclass(frozen=True)
class Model:
    """What scoring needs: the classes of ids, their shares of their classes, the network, and the counts of the base."""

    tokenizer: str
    class_of: np.ndarray  # of each id, the end id last
    share: np.ndarray  # natural log
    network: Attention
    texts: int  # texts learned from, which is the count of the end
    tokens: int
    distinct: int


def classes_of(counts: np.ndarray, alone: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each id and the log of its share of it; `near` has, for each id, the counts of those alone near it.

    The most frequent ids are classes of their own. The others are clustered by which of those stand near them
    (spherical k-means), which tells languages and word ends apart; those that have none near them are two bands of frequency.
    """
    groups = CLASSES - ALONE - 2
    class_of = np.full(len(counts), CLASSES - 1)
    class_of[counts > 0] = CLASSES - 2
    class_of[alone] = np.arange(len(alone))
    seen = np.flatnonzero(near.any(axis=1))
    if len(seen) >= groups:
        profile = np.sqrt(near[seen])
        profile /= np.linalg.norm(profile, axis=1, keepdims=True)
        weight = np.sqrt(counts[seen] + 1)
        heavy = np.argsort(-weight, kind="stable")
        centres = profile[heavy[:groups]]
        weighted = profile * weight[:, None]
        for _ in range(12):
            group = (profile @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, group, weighted)
            empty = ~np.bincount(group, minlength=groups).astype(bool)
            sums[empty] = centres[empty]
            centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        class_of[seen] = ALONE + (profile @ centres.T).argmax(axis=1)
    mass = np.bincount(class_of, counts + 1.0, CLASSES)
    return class_of, np.log((counts + 1.0) / mass[class_of])


def scored(file: dict[str, np.ndarray], counts: np.ndarray, model: Model) -> dict[str, np.ndarray]:
    """The results of the texts of a file, whose distinct words were counted so often."""
    counts = np.append(counts, model.texts)
    base = np.log((counts + 1) / (model.tokens + model.distinct + 1))
    ids, id_first, words, word_first = _with_ends(file, len(model.class_of) - 1, file["order"], file["first"])
    sizes = np.diff(id_first)[words]
    sequence, sub_first = _sequence(ids, id_first, words)
    found = model.network.score(model.class_of[sequence], sub_first[word_first]) + model.share[sequence]
    sums = np.concatenate([[0.0], np.cumsum(found, dtype=np.float64)])
    own, by_count = np.diff(sums[sub_first]), base[words]
    mixed = np.where(sizes > 0, np.logaddexp(own, by_count) - math.log(2), by_count)

    def per_text(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return np.diff(sums[word_first])

    # differences of running sums would lose digits; texts are added up one by one
    starts = word_first[:-1]
    return {
        "n_tokens": np.diff(word_first),
        "n_known": per_text(counts[words] > 0),
        "base_score": np.add.reduceat(by_count, starts) / math.log(10) if len(starts) else np.zeros(0),
        "score": np.add.reduceat(mixed, starts) / math.log(10) if len(starts) else np.zeros(0),
    }


_models: dict[str, Model] = {}


def score_texts(docs: DataFrame, tokenizer: str, modulus: int = 7, held_out: int = 2, file_bytes: int = FILE_BYTES, words_per_bucket: int = WORDS_PER_BUCKET) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every whole text."""
    aside = remainder(F.col("doc_id"), modulus)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(aside == held_out, F.lit(False)).alias("held_out"),
        F.coalesce(aside != held_out, F.lit(False)).alias("learned"),
    )
    end_id = load(tokenizer).get_vocab_size(with_added_tokens=True)
    manifest = _encode_files(rows, tokenizer, work_folder(docs.sparkSession, "lm"), file_bytes, end_id)
    count, texts = manifest.agg(F.count("*"), F.coalesce(F.sum("texts"), F.lit(0))).first()
    answers = _word_counts(manifest, words_per_bucket, count)
    distinct, tokens = answers.agg(F.sum("distinct"), F.sum("total")).first()
    id_counts = np.zeros(end_id + 1)
    for r in _id_counts(manifest, end_id).collect():  # one row an id of the tokenizer
        id_counts[r["id"]] = r["n"]
    id_counts[end_id] = texts
    alone, near = np.argsort(-id_counts, kind="stable")[:ALONE], np.zeros((end_id + 1, ALONE))
    for r in _near_counts(manifest, alone, end_id, count).collect() if texts else ():  # ALONE counts an id of the tokenizer
        part = np.frombuffer(r["near"], "<i8").reshape(-1, ALONE)
        near[r["block"] * _NEAR_BLOCK :][: len(part)] = part
    class_of, share = classes_of(id_counts, alone, near)
    mass = np.bincount(class_of, id_counts + 1.0, CLASSES)
    network = begun(CLASSES, np.log(np.maximum(mass, 1) / mass.sum()))
    network = _trained(manifest, id_counts.sum(), class_of, network) if texts else network
    model = Model(tokenizer, class_of.astype(np.uint8), share, network, texts, (tokens or 0) + texts, (distinct or 0) + (texts > 0))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # some hundred kilobytes

    def run(batches):
        model = sent.value
        for batch in batches:
            for i, path in enumerate(batch.column("path").to_pylist()):
                file = _load(path, "ids", "id_first", "order", "first", "held_out", "doc_id")
                parts = sorted(batch.column("answers")[i].as_py() or (), key=lambda r: r["bucket"])
                counts = np.frombuffer(b"".join(r["counts"] for r in parts), "<i8")
                found = scored(file, counts, model)
                n = len(file["doc_id"])
                columns = [
                    file["doc_id"],
                    pa.array(file["held_out"]),
                    pa.array(found["n_tokens"], pa.int64()),
                    pa.array(found["n_known"], pa.int64()),
                    pa.array(np.full(n, model.tokens, np.int64)),
                    pa.array(found["base_score"]),
                    pa.array(found["score"]),
                ]
                yield pa.record_batch(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    gathered = answers.groupBy("file").agg(F.collect_list(F.struct("bucket", "counts")).alias("answers"))
    known = manifest.select("file", "path").join(gathered, "file", "left").select("file", "path", "answers")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return spread(known, "file", count).mapInArrow(run, schema)
