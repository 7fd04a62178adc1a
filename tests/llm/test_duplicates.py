"""SimHash groups, substring repeats and components against plain versions."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from keyrill.llm import components, simhash, substrings
from keyrill.llm.words import Hasher, scan
from tests.llm.helpers import SF, awkward_rows, multiset, prose, table, words


def _fingerprint(text, width=3):
    found = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + width]) for i in range(max(1, len(found) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(prints, radius):
    """The number of the first member of each one's group."""
    group = list(range(len(prints)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return [root(x) for x in range(len(prints))]


def _components(rows, prints, radius):
    groups = _groups(prints, radius)
    least = {}
    for (i, _), g in zip(rows, groups):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, groups)]


@pytest.mark.parametrize("radius, tile", [(3, 2048), (3, 4), (12, 5)])
def test_near_duplicates(spark, radius, tile):
    rows = awkward_rows()
    found = simhash.near_duplicates(table(spark), radius=radius, tile=tile).collect()
    assert multiset(found) == multiset(_components(rows, [_fingerprint(t) for _, t in rows], radius))


def test_one_of_each(spark):
    rows = awkward_rows()
    frame = table(spark)
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    expected = _components(rows, [_fingerprint(t) for _, t in rows], 3)
    groups = {(c, p if c is None else "") for _, p, c in expected}
    assert multiset((r["doc_id"],) for r in kept.collect()) == multiset((c,) for c, _ in groups)
    nameless = [(None, prose(1, 40)), (None, prose(1, 40)), (None, prose(2, 40)), (7, prose(3, 40)), (7, prose(3, 40)), (7, prose(4, 40))]
    kept = simhash.one_of_each(table(spark, nameless)).collect()
    assert sorted(r["text"] for r in kept) == sorted({t for _, t in nameless})
    assert simhash.one_of_each(table(spark, [])).count() == 0


def test_tile_links_connect_what_all_pairs_connect():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (400, 4), dtype=np.uint64)
    prints = np.unique(np.append(np.bitwise_xor.reduce(np.where(rng.random((400, 4)) < 0.6, flips, 0).astype(np.uint64), axis=1) ^ rng.choice(centres, 400), centres))
    for most in (50, 1_000_000):
        u, v = simhash.tile_links(prints, prints, 3, most)
        assert len(u) < 2 * len(prints)  # a tile with itself has each print twice
        place = {int(p): i for i, p in enumerate(prints)}
        label = simhash.forest(np.array([place[int(x)] for x in u]), np.array([place[int(x)] for x in v]), len(prints))
        assert label.tolist() == _groups([int(p) for p in prints], 3)


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(500, 500)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    group = {}

    def root(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        group[high] = low
    expected = {(x, root(x)) for x in list(group) if root(x) != x}
    frame = spark.createDataFrame(edges, "u long, v long")
    assert {tuple(r) for r in components.components(frame).collect()} == expected
    assert components.components(frame.limit(0)).count() == 0


def _spans(rows, width):
    """Removed words of texts in order, by looking every window up."""
    seen, out = set(), []
    for _, text in rows:
        found = words(text)
        gone = [False] * len(found)
        for i in range(len(found) - width + 1):
            window = tuple(found[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        out.append((found, gone))
    return out


@pytest.mark.parametrize("width, file_bytes, bucket", [(20, 6_000_000, 2_000_000), (20, 3000, 50), (4, 2000, 100)])
def test_repeated_spans(spark, width, file_bytes, bucket):
    rows = awkward_rows()
    # rows without an id or with equal ids come in any order; give those the same text
    rows = [(i, t) for i, t in rows if i is not None] + [(None, rows[5][1])] * 2
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    found = substrings.repeated_spans(table(spark, rows), width, joined=True, file_bytes=file_bytes, words_per_bucket=bucket).collect()
    expected = []
    for (i, _), (all_words, gone) in zip(rows, _spans(rows, width)):
        expected.append((i, len(all_words), sum(gone), " ".join(w for w, g in zip(all_words, gone) if not g)))
    assert multiset((r["document"]["doc_id"], r["n_words"], r["n_removed"], r["document"]["text"]) for r in found) == multiset(expected)
    for r in found:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert r["document"]["file"] == "f" and r["document"]["row"] == 1


def test_texts_without_repeats_stay_as_they_are(spark):
    rows = [(1, "a  b\nc"), (2, prose(1, 60)), (3, f"x\n{prose(1, 60)}\n\ny"), (4, None)]
    found = {r["doc_id"]: r for r in substrings.without_repeats(table(spark, rows)).collect()}
    assert found[1]["text"] == "a  b\nc" and found[2]["text"] == rows[1][1] and found[4]["text"] == ""
    assert found[3]["text"].split() == ["x", "y"] and found[3]["n_chars"] == 3
    assert substrings.without_repeats(table(spark, [])).count() == 0


def test_registered_queries(spark):
    import __spark_entry__ as entry

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    found = entry.queries()["op6_substring_dedup"](spark, SF).orderBy("doc_id").collect()
    for r, (all_words, gone) in zip(found, _spans(docs, 20)):
        kept = " ".join(w for w, g in zip(all_words, gone) if not g)
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(all_words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    found = entry.queries()["op8_simhash"](spark, SF).collect()
    assert multiset(found) == multiset(_components(docs, [_fingerprint(t) for _, t in docs], 3))


def test_word_hashes():
    texts = [t or "" for _, t in awkward_rows()]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    starts, ends, first = scan(data, offsets)
    found = [data[s:e].tobytes().decode() for s, e in zip(starts, ends)]
    assert found == [w for t in texts for w in words(t)]
    assert np.diff(first).tolist() == [len(words(t)) for t in texts]
    hasher = Hasher(1)
    hashes = hasher.words(data, starts, ends)
    assert len(set(zip(found, hashes.tolist()))) == len(set(found)) == len(set(hashes.tolist()))
    windows = hasher.windows(hashes, 7)
    plain = [tuple(found[i : i + 7]) for i in range(len(found) - 6)]
    assert len(windows) == len(plain) and len(set(zip(plain, windows.tolist()))) == len(set(plain)) == len(set(windows.tolist()))
