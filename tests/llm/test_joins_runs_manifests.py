"""Overlap joins, periodic runs and Merkle manifests against plain versions and SQL."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from keyrill.llm import merkle, overlap_join, queries, runs
from tests.llm.helpers import SF, awkward_rows, multiset, prose, table, words

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _sets(rows):
    for _, text in rows:
        w = words((text or "").translate(_LOWER))
        yield frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def _overlaps(rows, percent=90):
    sets = list(_sets(rows))
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in lists[x])
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = sorted((root(i), root(j)))
                group[b] = a
        for x in s:
            lists[x].append(i)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(i, len(s), least.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def _edited(text, edits, rng):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture
def near_copies():
    """Groups of near copies of short and long texts; the last is a fifth of all rows, with a passage that all others share."""
    rng, rows = random.Random(3), []
    for g in range(40):
        base = prose(g, rng.choice([4, 9, 12, 30, 80, 200]), 2000)
        rows += [_edited(base, rng.choice([0, 0, 1, 1, 2, 3]), rng) for _ in range(rng.choice([1, 2, 5, 20]))]
    passage, base = prose(999, 40, 2000), prose(1000, 120, 2000)
    rows = [f"{passage} {t}" if i % 2 else t for i, t in enumerate(rows)]
    rows += [f"{passage} {_edited(base, rng.choice([1, 2, 4]), rng)}" for _ in range(len(rows) // 4)]
    return list(enumerate(rows))


@pytest.mark.parametrize("percent", [90, 70])
def test_overlap_join(spark, near_copies, percent):
    found = overlap_join.overlap_join(spark.createDataFrame(near_copies, "doc_id long, text string"), percent=percent).collect()
    assert multiset(found) == multiset(_overlaps(near_copies, percent))


def test_overlap_join_of_awkward_rows(spark):
    assert multiset(overlap_join.overlap_join(table(spark)).collect()) == multiset(_overlaps(awkward_rows()))
    assert overlap_join.overlap_join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_search_alone_and_short_chunks_find_the_same(spark, near_copies, monkeypatch):
    monkeypatch.setattr(overlap_join, "LEADER_ROUNDS", 1)
    monkeypatch.setattr(overlap_join, "_led", lambda entries, number, percent: entries.select(entries.cls.alias("u"), entries.cls.alias("v")).limit(0))
    monkeypatch.setattr(overlap_join, "CHUNK", 3)
    monkeypatch.setattr(overlap_join, "BROADCAST_ROWS", 0)
    found = overlap_join.overlap_join(spark.createDataFrame(near_copies, "doc_id long, text string")).collect()
    assert multiset(found) == multiset(_overlaps(near_copies))


def test_exactly_at_the_threshold(spark):
    """19 of 21 and 18 of 20 shingles: 90.47 % links, 90 % links, 17 of 19 does not."""
    def pair(n, at):
        w = [f"w{n}x{i}" for i in range(n)]
        return [" ".join(w), " ".join(w[:at] + ["other"] + w[at + 1 :]), " ".join([*w, "more"])]

    texts = [t for n in (11, 12, 20, 21, 39, 40, 41, 57, 58, 59) for at in (0, 1, n // 2) for t in pair(n, at)]
    rows = list(enumerate(texts))
    found = overlap_join.overlap_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert multiset(found) == multiset(_overlaps(rows))


def _runs(doc_id, text, planted):
    w = words(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if planted and doc_id is not None and n and h % 10 == 0:
        a, g = h // 10 % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = set()
    codes = np.array([hash(x) for x in w])
    for q in range(1, n // 4 + 1):
        equal = np.flatnonzero(codes[:-q] == codes[q:])
        for part in np.split(equal, np.flatnonzero(np.diff(equal) != 1) + 1):
            if len(part) and len(part) + q >= max(6, 4 * q):
                x = codes[part[0] : part[-1] + q + 1]
                if not any((x[:-p] == x[p:]).all() for p in range(1, q)):
                    found.add((int(part[0]), len(x), q))
    ordered = sorted(found, key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in ordered for i in range(s + q, s + length)}
    best = min(ordered, key=lambda r: (-r[1], r[0], r[2])) if ordered else (None, None, None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in ordered)
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    milli = 1000 * best[1] // best[2] if ordered else None
    return (doc_id, len(ordered), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def _periodic_texts(count):
    rng = random.Random(5)
    for i in range(count):
        parts = []
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.3:
                parts += [rng.choice("abcdefgh") for _ in range(rng.randint(1, 36))]
            else:
                letters = rng.choice(["ab", "abc", "abcdefghijklmnop"])
                unit = [rng.choice(letters) for _ in range(rng.randint(1, 60))]
                parts += (unit * rng.randint(1, 9))[: rng.randint(1, 300)]
        yield i, rng.choice([" ", "\n", "  "]).join(parts)


@pytest.mark.parametrize("planted", [True, False])
def test_periodic_runs(spark, planted):
    rows = awkward_rows() + list(_periodic_texts(300))
    found = runs.periodic_runs(table(spark, rows), planted).collect()
    expected = [_runs(i, t, planted) for i, t in rows]
    assert sum(r[1] for r in expected) > 200
    assert multiset(found) == multiset(expected)


def test_periodic_runs_of_many_texts():
    rows = list(_periodic_texts(2000))
    batch = runs._report([i for i, _ in rows], pa.array([t for _, t in rows]), True)
    assert list(zip(*(c.to_pylist() for c in batch.columns))) == [_runs(i, t, True) for i, t in rows]


def test_long_period_and_no_texts(spark):
    word = [f"w{i}" for i in range(9973)]
    text = " ".join(["x"] + word * 4 + word[:5] + ["y"])
    row = runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 1, 4 * 9973 + 5, 9973, 4000)
    assert runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def _digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _climb(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([_digest(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def _siblings(levels, i):
    for digests in levels[:-1]:
        start = i // 8 * 8
        yield digests[start:i], digests[i + 1 : start + 8]
        i //= 8


def _proofs(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append((r[0] is not None, r[0] or 0, _digest(*map(_field, r)), r))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {}
    for lang in langs:
        trees[lang].sort(key=lambda t: t[:3])
        levels[lang] = _climb([t[2] for t in trees[lang]])
    top = _climb([levels[lang][-1][0] for lang in langs])
    for j, lang in enumerate(langs):
        for i, (_, _, leaf, r) in enumerate(trees[lang]):
            path = [*_siblings(levels[lang], i), *_siblings(top, j)]
            digest = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                digest = _digest(*map(_field, (*r[:4], r[4].translate(_LOWER))))
            for left, right in path:
                digest = _digest(*left, digest, *right)
            proof = _digest(*(x for left, right in path for x in left + right))
            yield r[0], leaf, levels[lang][-1][0], top[-1][0], proof, digest, digest == top[-1][0]


_DOCUMENT = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("count", [0, 1, 8, 9, 70])
def test_proofs(spark, count):
    rng = random.Random(count)
    rows = [(i, rng.choice(["s", None, ""]), rng.choice(["en", "fr", "é", "z", None]), rng.choice([1, None]), rng.choice([None, "", "aB", "ab", "É"])) for i in range(count)]
    rows += rows[: count // 4] + [(None, "s", "en", 1, "X")] * (count // 8) + [(i, "s", f"l{i}", 1, "T") for i in range(count // 5)]
    assert multiset(merkle.proofs(spark.createDataFrame(rows, _DOCUMENT)).collect()) == multiset(_proofs(rows))


def test_proofs_of_a_deep_tree_and_clashing_columns(spark):
    rows = [(i, "s", "en", 1, f"T {i}" if i % 2 else f"t {i}") for i in range(600)]
    frame = spark.createDataFrame([(*r, 1, "x", 2, 3, "d", 4) for r in rows], f"{_DOCUMENT}, level int, tree string, low long, place long, digest string, row long")
    assert multiset(merkle.proofs(frame).collect()) == multiset(_proofs(rows))


def test_intervals_of_a_manifest(spark):
    """Leaves are ranked without gaps in each language, and a proof has a step for every level."""
    rows = [(i * 3, "s", "ab"[i % 2], 1, "t") for i in range(150)]
    found = merkle.manifest(spark.createDataFrame(rows, _DOCUMENT)).collect()
    ranks = sorted((r.subroot, r.low) for r in found)
    assert [low for _, low in ranks] == [*range(75), *range(75)]
    assert {len(r.path) for r in found} == {3 + 1}


@pytest.mark.parametrize("name", ["op11_overlap_join", "op13_merkle_manifest"])
def test_sql(spark, name):
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    expected = db.sql(queries.ORACLES[name])
    found = queries.QUERIES[name](spark, SF)
    assert found.columns == expected.columns
    assert multiset(found.collect()) == multiset(expected.fetchall())
