"""Operator 4: language by a convolutional network over bytes.

Fixed-length windows cover the whole text, one overlapping the next by the widest filter less one byte, the last one padded. Bytes are
embedded; filters of several widths slide over them; each filter's largest response in the window, if positive, goes to a softmax over the
languages. A document's probabilities are its windows' means, weighted by their bytes. The network is trained in numpy on labelled
documents: PER_LANGUAGE different ones of each language at most, those that come first by a hash of id and text, and WINDOWS windows
of each. With many languages there are fewer of each, so that all are no more than SAMPLE; beyond SAMPLE languages the most frequent are learned. For prediction the product of embedding and filters is tabulated for pairs of bytes, so that a filter of four
bytes takes two look-ups; the numbers are those of the network.

Prediction reads the text alone. Null texts and texts without a letter are `und` with score 0, as is everything if no language was
learned. Of languages with equal scores the first by name is predicted. A null id is not held out and not learned from. Equal ids and repeated rows
keep their rows; a repeated row is learned from once. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyrill.llm.common import remainder, slices, string_buffer

PER_LANGUAGE = 800
SAMPLE = 50_000
WINDOWS = 4
LENGTH = 256
WIDTHS = (2, 3, 4)
_FILTERS = 16
_EMBEDDING = 8
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Network:
    languages: tuple[str, ...]
    embedding: np.ndarray  # [256, e]
    filters: tuple[np.ndarray, ...]  # of each width, [width, e, f]
    biases: tuple[np.ndarray, ...]
    dense: np.ndarray  # [filters of all widths, languages]
    offset: np.ndarray

    def key(self) -> str:
        parts = (self.embedding, *self.filters, *self.biases, self.dense, self.offset)
        return hashlib.sha256(b"".join(p.tobytes() for p in parts)).hexdigest()


def windows_of(data: np.ndarray, offsets: np.ndarray, length: int, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts as rows of bytes, the text of each, and how many of its bytes are the text's."""
    step = length - overlap
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-(sizes - overlap) // step))
    text = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = offsets[:-1][text] + nth * step
    left = offsets[1:][text] - begins
    places = begins[:, None] + np.arange(length)
    inside = np.arange(length) < left[:, None]
    padded = np.append(data, np.uint8(0))
    return np.where(inside, padded[np.minimum(places, len(data))], np.uint8(0)), text, np.clip(left, 0, length)


class Tables:
    """A network's responses, tabulated for bytes and pairs of bytes."""

    def __init__(self, network: Network) -> None:
        self.network, self.parts = network, []
        for filters, bias in zip(network.filters, network.biases):
            width, tables = len(filters), []
            singles = np.einsum("be,wef->wbf", network.embedding, filters).astype(np.float32)
            for j in range(0, width - 1, 2):
                pairs = (singles[j][:, None, :] + singles[j + 1][None, :, :]).reshape(65536, -1)
                tables.append((j, True, pairs + (bias.astype(np.float32) if j == 0 else 0)))
            if width % 2:
                tables.append((width - 1, False, singles[width - 1] + (bias.astype(np.float32) if width == 1 else 0)))
            self.parts.append((width, tables))

    def probabilities(self, rows: np.ndarray, run: int = 256) -> np.ndarray:
        out = np.empty((len(rows), len(self.network.languages)), np.float32)
        for start in range(0, len(rows), run):
            part = rows[start : start + run].astype(np.intp)
            pairs = part[:, :-1] * 256 + part[:, 1:]
            hidden = []
            for width, tables in self.parts:
                last, total = part.shape[1] - width + 1, None
                for j, paired, table in tables:
                    found = table[(pairs if paired else part)[:, j : j + last]]
                    if total is None:
                        total = found
                    else:
                        total += found
                hidden.append(total.max(axis=1))
            out[start : start + run] = _softmax(np.maximum(np.concatenate(hidden, axis=1), 0) @ self.network.dense + self.network.offset)
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: np.ndarray, language: np.ndarray, languages: tuple[str, ...], epochs: int = 6, batch: int = 64, rate: float = 0.004) -> Network:
    """Fit a network to windows (rows of bytes) and the numbers of their languages, by Adam on the cross-entropy."""
    rng = np.random.default_rng(4)
    count = len(languages)
    parameters = [rng.normal(0, 0.3, (256, _EMBEDDING))]
    parameters += [rng.normal(0, (w * _EMBEDDING) ** -0.5, (w, _EMBEDDING, _FILTERS)) for w in WIDTHS]
    parameters += [np.zeros(_FILTERS) for _ in WIDTHS]
    parameters += [rng.normal(0, 0.1, (_FILTERS * len(WIDTHS), count)), np.zeros(count)]
    parameters = [p.astype(np.float32) for p in parameters]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    n, step = len(WIDTHS), 0
    each = np.bincount(language, minlength=count)
    weight = (len(language) / np.maximum(each, 1) / count)[language].astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            x = rows[chosen].copy()
            short = rng.random(len(x)) < 0.3  # short texts are common
            x[short] = np.where(np.arange(x.shape[1]) < rng.integers(12, 120, (short.sum(), 1)), x[short], 0)
            embedding, filters, biases, dense, offset = parameters[0], parameters[1 : n + 1], parameters[n + 1 : 2 * n + 1], parameters[-2], parameters[-1]
            e = embedding[x]
            tops, values = [], []
            for kernel, bias in zip(filters, biases):
                places = x.shape[1] - len(kernel) + 1
                response = sum(e[:, j : j + places] @ kernel[j] for j in range(len(kernel)))
                top = response.argmax(axis=1)
                tops.append(top)
                values.append(np.take_along_axis(response, top[:, None, :], axis=1)[:, 0] + bias)
            raw = np.concatenate(values, axis=1)
            hidden = np.maximum(raw, 0)
            wrong = _softmax(hidden @ dense + offset)
            wrong[np.arange(len(x)), language[chosen]] -= 1
            wrong *= weight[chosen][:, None] / len(x)
            back = (wrong @ dense.T) * (raw > 0)
            gradients = [np.zeros_like(embedding), *[None] * (2 * n), hidden.T @ wrong, wrong.sum(axis=0)]
            for k, (kernel, top) in enumerate(zip(filters, tops)):
                own = back[:, k * _FILTERS : (k + 1) * _FILTERS]
                places = top[:, :, None] + np.arange(len(kernel))
                letters = x[np.arange(len(x))[:, None, None], places]  # [row, filter, j]
                gradients[1 + k] = np.einsum("bfje,bf->jef", embedding[letters], own)
                gradients[1 + n + k] = own.sum(axis=0)
                np.add.at(gradients[0], letters, own[:, :, None, None] * kernel.transpose(2, 0, 1)[None])
            step += 1
            for p, g, m, v in zip(parameters, gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(languages, parameters[0], tuple(parameters[1 : n + 1]), tuple(parameters[n + 1 : 2 * n + 1]), parameters[-2], parameters[-1])


def learn(docs: DataFrame, modulus: int = 4, held_out: int = 2) -> Network | None:
    """Train on a bounded sample of the labelled documents that are not held out."""
    known = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"), "lang").where(
        F.col("lang").isNotNull() & (remainder(F.col("doc_id"), modulus) != held_out)
    )
    known = known.withColumn("place", F.xxhash64("id", "text"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("place").alias("different")).orderBy(F.desc("n"), "lang")
    different = {r["lang"]: r["different"] for r in counts.limit(SAMPLE).collect()}
    if not different:
        return None
    most = max(1, min(PER_LANGUAGE, SAMPLE // len(different)))
    # the first by hash are looked for among some thousands only; three times as many, as the hashes are counted roughly
    bounds = [(lang, int(2**63 * (2 * min(1.0, 3 * most / n) - 1)) - 1) for lang, n in different.items()]
    bounds = F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, bound long"))  # SAMPLE short rows at most
    sample = known.join(bounds, "lang").where("place <= bound").select("lang", "place", "text")

    def cut(batches):
        for batch in batches:
            for part in slices(batch):
                rows, text, _ = windows_of(*string_buffer(part.column("text")), LENGTH, max(WIDTHS) - 1)
                first = np.searchsorted(text, np.arange(part.num_rows + 1))
                spread = [np.unique(np.linspace(s, e - 1, WINDOWS).astype(int)) for s, e in zip(first, first[1:])]
                cuts = pa.array([rows[s].tobytes() for s in spread], pa.binary())
                yield pa.record_batch([part.column("lang"), part.column("place"), cuts], names=["lang", "place", "cuts"])

    cuts = sample.mapInArrow(cut, "lang string, place long, cuts binary").groupBy("lang", "place").agg(F.min("cuts").alias("cuts"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    found = cuts.withColumn("nth", first).where(F.col("nth") <= most).toArrow().to_pandas().sort_values(["lang", "place"])
    languages = tuple(sorted(found["lang"].unique()))
    if not languages:
        return None
    cuts = [np.frombuffer(c, np.uint8).reshape(-1, LENGTH) for c in found["cuts"]]
    numbers = np.repeat([languages.index(lang) for lang in found["lang"]], [len(c) for c in cuts])
    return train(np.concatenate(cuts), numbers, languages)


_tables: dict[str, Tables] = {}


def predict(docs: DataFrame, network: Network | None, modulus: int = 4, held_out: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text; no shuffle."""
    key = network.key() if network else ""

    def run(batches):
        if network and key not in _tables:
            _tables.clear()
            _tables[key] = Tables(network)
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                names, scores = ["und"] * len(texts), np.zeros(len(texts))
                if network:
                    rows, text, size = windows_of(*string_buffer(part.column("text")), LENGTH, max(WIDTHS) - 1)
                    found = _tables[key].probabilities(rows) * np.maximum(size, 1)[:, None]
                    sums = np.add.reduceat(found, np.searchsorted(text, np.arange(len(texts))), axis=0, dtype=np.float64)
                    sums /= sums.sum(axis=1, keepdims=True)
                    lettered = [t is not None and bool(_LETTER.search(t)) for t in texts]
                    best = sums.argmax(axis=1)
                    names = [network.languages[b] if ok else "und" for b, ok in zip(best, lettered)]
                    scores = np.where(lettered, np.clip(sums.max(axis=1), 0, 1), 0.0)
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores)]
                yield pa.record_batch(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    aside = F.coalesce(remainder(F.col("doc_id"), modulus) == held_out, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), aside.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
