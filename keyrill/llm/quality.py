"""Operator 5: quality rules, a fixed base and gradient-boosted trees over statistics of documents.

The trees are grown in numpy on labelled documents (at most `sample` of them, the smallest by hash of the id), with logistic loss on
binned features. For the features in FALLING the score may only fall as the feature grows: a split that would break this is not
made, and the bounds that it sets hold for all below it. The forest is flattened into arrays of nodes, so that scoring a batch takes one
indexing step a level and tree. A document is kept if the base passes and its score is not below a threshold, which is set so that
at most `lost` of the good documents set aside from training fall below it.

Null texts have no words and fail the base. Without labels of both kinds the base alone decides. Null labels and labels of unknown
documents are ignored, repeated labels count each. Rows with null or equal ids are judged like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.llm.common import held, remainder, return_freed_memory, slices, string_buffer
from keyrill.llm.words import Hasher, inside, scan

SAMPLE = 20_000
WINDOW = 5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"'()*,-./:;?[]_`{}~")] = True
_BLANK = " \t\n\r\x0b\x0c"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_OTHERS = ["n_upper", "n_digits", "n_marks", "n_lines", "n_distinct"]
FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "words_per_line", "distinct"]
FALLING = ["symbols", "dup_lines", "repeats"]


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text of a column."""
    hasher = held("quality", 5, lambda: Hasher(5))
    data, offsets = string_buffer(column)
    starts, ends, first = scan(data, offsets)
    n_words = np.diff(first)
    spaces = np.isin(data, np.array([9, 10, 11, 12, 13, 32], np.uint8))

    hashes = hasher.words(data, starts, ends)
    text_of = np.repeat(np.arange(len(n_words), dtype=np.uint64), n_words)
    salt = (text_of + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    repeated = np.zeros(len(hashes), bool)
    windows = hasher.windows(hashes, WINDOW)
    whole = np.flatnonzero(inside(first, len(hashes), WINDOW)[: len(windows)])
    if len(whole):
        _, inverse, counts = np.unique(windows[whole] ^ salt[whole], return_inverse=True, return_counts=True)
        twice = np.zeros(len(hashes), bool)
        twice[whole] = counts[inverse] > 1
        repeated = twice.copy()
        for shift in range(1, WINDOW):
            repeated[shift:] |= twice[:-shift]
    _, one = np.unique(hashes ^ salt, return_index=True)
    distinct = np.zeros(len(hashes), bool)
    distinct[one] = True

    dup_lines, n_lines = [], []
    for text in column.to_pylist():
        lines = [line for line in (text or "").split("\n") if line.strip(_BLANK)]
        n_lines.append(len(lines))
        dup_lines.append(len(lines) - len(set(lines)))
    return {
        "n_words": n_words,
        "word_chars": _per_text(((data & 0xC0) != 0x80) & ~spaces, offsets),
        "n_symbols": _per_text(_SYMBOLS[data], offsets),
        "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": _per_text(repeated, first),
        "n_upper": _per_text(_UPPER[data], offsets),
        "n_digits": _per_text(_DIGIT[data], offsets),
        "n_marks": _per_text(_MARK[data], offsets),
        "n_lines": np.array(n_lines, np.int64),
        "n_distinct": _per_text(distinct, first),
    }


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """One row a document, in the order of FEATURES."""
    words, chars, lines = (np.maximum(counts[c], 1) for c in ("n_words", "word_chars", "n_lines"))
    return np.column_stack(
        [
            np.log1p(counts["n_words"]),
            counts["word_chars"] / words,
            counts["n_symbols"] / words,
            counts["n_dup_lines"] / lines,
            counts["n_repeat_words"] / words,
            counts["n_upper"] / chars,
            counts["n_digits"] / chars,
            counts["n_marks"] / words,
            counts["n_words"] / lines,
            counts["n_distinct"] / words,
        ]
    )


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])


@dataclass(frozen=True)
class Forest:
    """Trees of one depth as arrays of nodes, [tree, node]; the children of node i are 2i + 1 and 2i + 2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int
    start: float
    cut: float = -np.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of good quality of each row."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node]
        return 1 / (1 + np.exp(-total))

    def keeps(self, x: np.ndarray) -> np.ndarray:
        return self.score(x) >= self.cut


def _grow(bins, edges, gradient, hessian, falling, depth, rate, ridge=1.0, least=20):
    """One tree on binned features, level by level, as (feature, threshold, value) of its nodes."""
    count = 2 ** (depth + 1) - 1
    feature, threshold, value = np.zeros(count, np.int64), np.full(count, np.inf), np.zeros(count)
    low, high = np.full(count, -np.inf), np.full(count, np.inf)
    node, levels = np.zeros(len(bins), np.int64), max(len(e) for e in edges) + 1
    best_value = lambda g, h, at: np.clip(-g / (h + ridge), low[at], high[at])
    gain_at = lambda g, h, w: -(g * w + 0.5 * (h + ridge) * w * w)
    value[0] = best_value(gradient.sum(), hessian.sum(), 0)
    for at in range(2**depth - 1):
        mine = np.flatnonzero(node == at)
        g, h = gradient[mine].sum(), hessian[mine].sum()
        stay, best = gain_at(g, h, value[at]), (1e-6, None)
        for f in range(bins.shape[1]) if len(mine) >= 2 * least else ():
            sums = [np.cumsum(np.bincount(bins[mine, f], weights, levels))[:-1] for weights in (gradient[mine], hessian[mine], None)]
            left, right = best_value(sums[0], sums[1], at), best_value(g - sums[0], h - sums[1], at)
            gains = gain_at(sums[0], sums[1], left) + gain_at(g - sums[0], h - sums[1], right) - stay
            allowed = (sums[2] >= least) & (len(mine) - sums[2] >= least) & (np.arange(levels - 1) < len(edges[f]))
            if f in falling:
                allowed &= left >= right
            gains = np.where(allowed, gains, -np.inf)
            if gains.max() > best[0]:
                best = (gains.max(), (f, int(gains.argmax()), left[gains.argmax()], right[gains.argmax()]))
        a, b = 2 * at + 1, 2 * at + 2
        low[[a, b]], high[[a, b]], value[[a, b]] = low[at], high[at], value[at]
        if best[1] is None:
            node[mine] = a
            continue
        f, cut, left, right = best[1]
        feature[at], threshold[at], value[a], value[b] = f, edges[f][cut], left, right
        if f in falling:
            low[a] = high[b] = (left + right) / 2
        node[mine] = np.where(bins[mine, f] <= cut, a, b)
    return feature, threshold, rate * value


def boost(x: np.ndarray, good: np.ndarray, held_out: np.ndarray, trees=60, depth=3, rate=0.15, bins=48, lost=0.002) -> Forest | None:
    """A forest for the probability of `good`; None unless both kinds are there. `lost` bounds the good ones below the cut."""
    fit = ~held_out
    if len(np.unique(good[fit])) < 2:
        return None
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x[fit].T]
    binned = np.column_stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x[fit].T)])
    falling = {FEATURES.index(name) for name in FALLING}
    y = good[fit].astype(float)
    start = float(np.log(y.mean() / (1 - y.mean())))
    total, grown = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        feature, threshold, value = _grow(binned, edges, p - y, p * (1 - p), falling, depth, rate)
        grown.append((feature, threshold, value))
        node, rows = np.zeros(len(y), np.int64), np.arange(len(y))
        for _ in range(depth):
            node = 2 * node + 1 + (x[fit][rows, feature[node]] > threshold[node])
        total += value[node]
    forest = Forest(*(np.stack(part) for part in zip(*grown)), depth, start)
    kept = forest.score(x[held_out & good]) if (held_out & good).any() else forest.score(x[good])
    return Forest(forest.feature, forest.threshold, forest.value, depth, start, float(min(0.5, np.quantile(kept, lost))))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest | None:
    """Fit the forest on at most `sample` labelled documents, a fifth of them (by crc32 of the id) set aside for the cut."""
    chosen = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("id"), "quality")
    # the smallest hashes are looked for among twice as many rows as needed, however many tasks there are
    share = min(1.0, 2 * sample / max(1, chosen.count()))
    chosen = chosen.where(F.xxhash64("id") < int(2**63 * (2 * share - 1))) if share < 1 else chosen
    chosen = chosen.orderBy(F.xxhash64("id"), "quality").limit(sample)

    def count(batches):
        for batch in batches:
            for part in slices(batch):
                found = statistics(part.column("text"))
                columns = [part.column("held_out"), part.column("good"), *(pa.array(found[c]) for c in COUNTS + _OTHERS)]
                yield pa.record_batch(columns, names=["held_out", "good", *COUNTS, *_OTHERS])

    schema = "held_out boolean, good boolean, " + ", ".join(f"{c} long" for c in COUNTS + _OTHERS)
    known = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # at most `sample` rows of two numbers, so it may be sent to every task
    rows = known.join(F.broadcast(chosen.groupBy("id").agg(F.min("quality").alias("quality"))), "id").orderBy(F.xxhash64("id", "text"), "quality").limit(sample)
    rows = rows.select("text", (remainder(F.col("id"), 5) == 0).alias("held_out"), (F.col("quality") > 0).alias("good"))
    rows = rows.mapInArrow(count, schema).toArrow()
    x = features({c: rows.column(c).to_numpy() for c in COUNTS + _OTHERS})
    good, held_out = (np.array(rows.column(c).to_pylist(), bool) for c in ("good", "held_out"))
    order = np.lexsort((good, *x.T))  # the rows come in any order
    return boost(x[order], good[order], held_out[order]) if len(x) else None


def judged(text: Column, forest: Forest | None) -> Column:
    """A struct of the counts, base_failed, kept and score (null without a forest) of each text."""
    kind = ", ".join(f"{c}: bigint" for c in COUNTS) + ", base_failed: boolean, kept: boolean, score: double"

    @F.arrow_udf(f"struct<{kind}>")
    def judge(column: pa.Array) -> pa.Array:
        parts = []
        for part in slices(pa.record_batch([column], names=["text"])):
            found = statistics(part.column("text"))
            failed = base_failed(found)
            if forest is None:
                kept, score = ~failed, pa.nulls(len(failed), pa.float64())
            else:
                score = forest.score(features(found))
                kept, score = ~failed & (score >= forest.cut), pa.array(score)
            columns = [*(pa.array(found[c], pa.int64()) for c in COUNTS), pa.array(failed), pa.array(kept), score]
            parts.append(pa.StructArray.from_arrays(columns, names=[*COUNTS, "base_failed", "kept", "score"]))
            return_freed_memory()
        if not parts:
            flags = [(name, pa.bool_()) for name in ("base_failed", "kept")]
            return pa.nulls(0, pa.struct([*((c, pa.int64()) for c in COUNTS), *flags, ("score", pa.float64())]))
        return pa.concat_arrays(parts)

    return judge(text)


def quality_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score); no shuffle."""
    forest = learn(docs, labels, sample)
    return docs.select("doc_id", judged(F.col("text"), forest).alias("found")).select("doc_id", "found.*")


def kept_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs`, all columns, that the rules keep."""
    forest = learn(docs, labels, sample)
    return docs.withColumn("__quality", judged(F.col("text"), forest)).where("__quality.kept").drop("__quality")
