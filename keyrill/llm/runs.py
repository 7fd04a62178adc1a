"""Operator 12: periodic runs of words, by recursive frequency splitting.

A run of period q is at least max(6, 4 q) words long, so each of its words occurs at least four times in it. Within a segment of a text, a
word that occurs less often can be in no run that lies in the segment: it splits it. What is left is counted and split again until
every word of every segment occurs often enough, or the segment is too short. Surviving segments are scanned lag by lag for
stretches of words that are equal to the word a lag later.

Short lags are scanned over all segments of a batch at once. Longer ones are looked for by their octave: a run with a period of w to 2 w
words holds, at some multiple of w, a block of w words that comes again a period later. The blocks at multiples of w are compared, by hash,
with all places w to 2 w words later, which is one comparison for each word and octave; lags found there are checked and extended
word by word. A lag whose stretch is periodic with a smaller period that divides it is no run: by the theorem of Fine and Wilf the smallest
period of so long a stretch divides all others. Work is n log n in the words of a text.

Nothing is shuffled: a text is a row of a batch, and batches are cut into runs of rows of bounded size; a longer text is a batch of its
own and takes some sixteen times its size. Null and empty texts have no words, no runs and the digests of nothing. Null ids keep their row and change no words;
repeated rows stay rows. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from keyrill.llm.common import return_freed_memory, slices, texts

LEAST_WORDS = 6
LEAST_PERIODS = 4
_SHORT_LAGS = 16


def split_by_frequency(codes: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, segment) of the words that can be in runs; segments are numbered anew and hold consecutive words.

    `codes` tells words apart, `segment` names the text of each.
    """
    place = np.arange(len(codes))
    while len(place):
        # occurrences of each word in its segment, by sorting the pairs
        order = np.lexsort((codes[place], segment))
        c, s = codes[place][order], segment[order]
        new = np.concatenate([[True], (c[1:] != c[:-1]) | (s[1:] != s[:-1])])
        group = np.cumsum(new) - 1
        often = np.empty(len(place), bool)
        often[order] = np.bincount(group)[group] >= LEAST_PERIODS
        edge = np.concatenate([[True], (segment[1:] != segment[:-1])])
        before = len(place)
        # a dropped word ends the segment before it and begins another after it
        cut = np.cumsum(edge | ~often | np.concatenate([[False], ~often[:-1]]))
        place, segment = place[often], cut[often]
        if len(place):
            number = np.cumsum(np.concatenate([[0], np.diff(segment) != 0]))
            long = np.bincount(number)[number] >= LEAST_WORDS
            place, segment = place[long], number[long]
        if len(place) == before:
            break
    return place, segment


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


class _Found:
    """The runs of one segment, by start and end; periods come in rising order.

    A stretch with a period that is a multiple of its smallest has the start and the end of the run found before.
    """

    def __init__(self) -> None:
        self.runs: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, period: int) -> None:
        self.runs.setdefault((start, end), period)


def _extended(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from `at` on, in steps of 1 or -1, are equal to those a lag later."""
    count, width = 0, 64
    while True:
        if step > 0:
            low, high = at + count, min(at + count + width, len(words) - lag)
        else:
            low, high = max(0, at + 1 - count - width), at + 1 - count
        if low >= high:
            return count
        differ = np.flatnonzero(words[low:high] != words[low + lag : high + lag])
        if len(differ):
            return count + (int(differ[0]) if step > 0 else high - low - 1 - int(differ[-1]))
        count += high - low
        width *= 2


def _long_lags(words: np.ndarray, found: _Found) -> None:
    """Add the runs of periods of _SHORT_LAGS words and more in a segment."""
    n, width, hashes = len(words), 1, _mixed(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    while LEAST_PERIODS * width <= n:
        if width >= _SHORT_LAGS:
            blocks = np.arange(0, len(hashes), width)
            matches = []
            for first in range(0, len(blocks), max(1, (1 << 18) // width)):
                part = blocks[first : first + max(1, (1 << 18) // width)]
                later = part[:, None] + np.arange(width, 2 * width)[None, :]
                same = hashes[np.minimum(later, len(hashes) - 1)] == hashes[part][:, None]
                b, k = np.nonzero(same & (later < len(hashes)))
                matches.append(np.stack([part[b], k + width]))
            at, lag = np.concatenate(matches, axis=1) if matches else np.zeros((2, 0), np.int64)
            fresh = np.ones(len(at), bool)
            for (start, end), period in found.runs.items():  # not those inside a run that is known already
                low, high = np.searchsorted(at, (start, end))
                fresh[low:high] &= (at[low:high] + lag[low:high] + width > end) | (lag[low:high] % period != 0)
            at, lag = at[fresh], lag[fresh]
            order = np.lexsort((at, lag))
            reached = (0, 0)  # the lag and the end of the last stretch looked at
            for a, q in zip(at[order].tolist(), lag[order].tolist()):
                if (q == reached[0] and a < reached[1]) or not np.array_equal(words[a : a + width], words[a + q : a + q + width]):
                    continue
                start, end = a - _extended(words, a - 1, q, -1), a + _extended(words, a, q, 1)
                reached = (q, end)
                if end + q - start >= LEAST_PERIODS * q:
                    found.add(start, end + q, q)
        hashes = _mixed(hashes[: len(hashes) - width] * np.uint64(0x9E3779B97F4A7C15) + hashes[width:])
        width *= 2


def word_runs(codes: np.ndarray, segment: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs, as places among `codes`; runs lie within one segment."""
    place, segment = split_by_frequency(codes, segment)
    if not len(place):
        return []
    words = codes[place]
    first = np.flatnonzero(np.concatenate([[True], np.diff(segment) != 0]))
    last = np.append(first[1:], len(place))
    runs: list[_Found] = [_Found() for _ in first]
    longest = int((last - first).max())
    for lag in range(1, min(_SHORT_LAGS - 1, longest // LEAST_PERIODS) + 1):
        equal = (words[:-lag] == words[lag:]) & (segment[:-lag] == segment[lag:])
        starts, ends = _stretches(equal)
        ends = ends + lag
        long = ends - starts >= max(LEAST_WORDS, LEAST_PERIODS * lag)
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            number = int(segment[start])
            runs[number].add(start - int(first[number]), end - int(first[number]), lag)
    for number in np.flatnonzero(last - first >= LEAST_PERIODS * _SHORT_LAGS).tolist():
        _long_lags(words[first[number] : last[number]], runs[number])
    return [(int(place[first[k]]) + s, int(place[first[k]]) + e, p) for k, found in enumerate(runs) for (s, e), p in found.runs.items()]


def repeating_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) if the words of this document from a on are replaced by repeats of the p words from a on."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _report(ids: list, column: pa.Array, planted: bool) -> pa.RecordBatch:
    """The rows of `periodic_runs` for some texts."""
    split = pc.ascii_split_whitespace(column.cast(pa.large_binary()).cast(pa.large_string()))
    split = split.cast(pa.large_list(pa.large_string()))
    held = split.flatten()
    filled = pc.greater(pc.binary_length(held), 0).to_numpy(zero_copy_only=False)
    lists = np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
    words, text = held.filter(pa.array(filled)), lists[filled]
    codes = words.dictionary_encode()
    distinct, codes = codes.dictionary, codes.indices.to_numpy(zero_copy_only=False).copy()
    counts = np.bincount(text, minlength=len(split))
    begins = np.concatenate([[0], np.cumsum(counts)])
    if planted:
        for i, doc_id in enumerate(ids):
            tail = repeating_tail(doc_id, int(counts[i]))
            if tail is not None:
                a, p = int(begins[i]) + tail[0], tail[1]
                codes[a : begins[i + 1]] = np.resize(codes[a : a + p], begins[i + 1] - a)

    kept = np.ones(len(codes), bool)
    of_text: dict[int, list[tuple[int, int, int]]] = {}
    for start, end, period in word_runs(codes, text):
        of_text.setdefault(int(text[start]), []).append((start - int(begins[text[start]]), end - start, period))
        kept[start + period : end] = False

    offsets = np.concatenate([[0], np.cumsum(np.bincount(text[kept], minlength=len(split)))])
    left = pa.LargeListArray.from_arrays(pa.array(offsets), distinct.take(pa.array(codes[kept])))
    joined = pc.binary_join(left, pa.scalar(" ", pa.large_string()))
    rows = []
    for i, doc_id in enumerate(ids):
        runs = sorted(of_text.get(i, ()), key=lambda r: (r[0], r[2]))
        digest = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        milli = 1000 * best[1] // best[2] if runs else None
        rows.append((doc_id, len(runs), *best, milli, digest, hashlib.sha256(joined[i].as_buffer()).hexdigest()))
    kinds = (*[pa.int64()] * 6, pa.string(), pa.string())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_COLUMNS)


_COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row.

    start to exponent_milli are those of the longest run (of equals the first, then that of the smallest period), null without
    runs. With `planted`, the texts of some ids first get a repeating tail, as `repeating_tail` says.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _report(part.column("doc_id").to_pylist(), part.column("text"), planted)
                return_freed_memory()

    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return texts(docs).mapInArrow(report, schema)
