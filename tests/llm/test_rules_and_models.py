"""Quality rules, languages and language-model scores: counts against plain versions, models on held-out rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from keyrill.llm import attention, language_id, language_model, quality
from keyrill.llm.tokenizing import token_ids
from tests.llm.helpers import SF, awkward_rows, multiset, prose, table, words

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _counts(text):
    found = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    windows = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    repeated = {k for i in range(len(found) - 4) if windows[tuple(found[i : i + 5])] > 1 for k in range(i, i + 5)}
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated))


def _failed(counts):
    return counts[0] < 10 or 100 * counts[4] > 20 * counts[0]


def test_quality_counts(spark):
    rows = [*awkward_rows(), (200, "# a\n# a\n\n # a\n<b> |c| $5 & 10%"), (201, "a b c d e f a b c d e g h i j k l m n o p q r s t u v w x y z")]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality.quality_rules(table(spark, rows), labels).collect()
    expected = [(i, *_counts(t), _failed(_counts(t)), not _failed(_counts(t)), None) for i, t in rows]
    assert multiset(found) == multiset(expected)
    assert quality.quality_rules(table(spark, []), labels).count() == 0


def test_quality_model_rejects_what_labels_reject(spark):
    good = [(i, prose(i, 80)) for i in range(200)]
    bad = [(1000 + i, " ".join(w + "***" for w in prose(i, 80).split())) for i in range(200)]
    labels = [(i, 1, 0) for i, _ in good[:150]] + [(i, 0, 0) for i, _ in bad[:150]] + [(None, 1, 0), (5, None, 0), (99_999, 1, 0), (6, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = table(spark, good + bad)
    found = {r["doc_id"]: r["kept"] for r in quality.quality_rules(frame, labels).collect()}
    assert all(found[i] for i, _ in good) and not any(found[i] for i, _ in bad)
    kept = quality.kept_documents(frame, labels)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {i for i, _ in good}


def test_forest_is_monotonic():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.FEATURES)))
    # the truth rises with symbols on one side of another feature: the constraint must not let that in
    good = np.where(x[:, 5] > 0.5, x[:, 2] > 0.4, x[:, 2] < 0.6) ^ (rng.random(3000) < 0.1)
    forest = quality.boost(x, good, rng.random(3000) < 0.2, trees=30)
    falling = [quality.FEATURES.index(name) for name in quality.FALLING]
    for f in falling:
        low, high = x.copy(), x.copy()
        low[:, f], high[:, f] = np.sort(rng.random((2, 3000)), axis=0)
        assert (forest.score(low) >= forest.score(high) - 1e-12).all()
    plain = np.full(50, forest.start)
    for t in range(len(forest.feature)):
        for row in range(50):
            node = 0
            for _ in range(forest.depth):
                node = 2 * node + 1 + int(x[row, forest.feature[t, node]] > forest.threshold[t, node])
            plain[row] += forest.value[t, node]
    assert np.allclose(forest.score(x[:50]), 1 / (1 + np.exp(-plain)))
    assert quality.boost(x, np.ones(3000, bool), np.zeros(3000, bool)) is None


def test_quality_query(spark):
    import __spark_entry__ as entry

    found = {r["doc_id"]: r for r in entry.queries()["op5_quality_rules"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        row, counts = found[r["doc_id"]], _counts(r["text"])
        assert tuple(row[c] for c in quality.COUNTS) == counts and row["base_failed"] == _failed(counts)
        assert not (row["kept"] and row["base_failed"])


@pytest.fixture(scope="module")
def network(spark):
    return language_id.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_languages(spark, network):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.predict(docs, network).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    held_out = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert len(held_out) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in held_out]) > 0.98


def test_language_of_awkward_rows(spark, network):
    found = language_id.predict(table(spark), network).collect()
    assert len(found) == len(awkward_rows())
    for r in found:
        assert 0 <= r["score"] <= 1 and (r["doc_id"] is not None or r["held_out"] is False)
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (120, 121, 122))
    assert language_id.learn(table(spark, [])) is None
    assert {r["lang_pred"] for r in language_id.predict(table(spark), None).collect()} == {"und"}


def test_languages_of_repeated_ids_and_of_many_languages(spark, monkeypatch):
    schema = "doc_id long, text string, lang string"
    two = [(4, " ".join(random.Random(i).choices(["the", "and", "ship", "over"] if i % 2 else ["łódź", "żółw", "gęś"], k=12)), "xy"[i % 2]) for i in range(3000)]
    for ident in (4, 8, 10):
        frame = spark.createDataFrame([(ident, text, lang) for _, text, lang in two], schema)
        network = language_id.learn(frame)
        found = language_id.predict(frame, network).groupBy("lang_pred").count().collect()
        assert {r["lang_pred"]: r["count"] for r in found} == {"x": 1500, "y": 1500}
    seen = []
    monkeypatch.setattr(language_id, "train", lambda windows, numbers, languages: seen.append((len(windows), languages)))
    language_id.learn(spark.createDataFrame([(5, "the same text", "x")] * 400 + [(6, "another", "x")], schema))
    many = [(i, f"text {i}", f"l{i % 90:02}") for i in range(900)]
    language_id.learn(spark.createDataFrame(many, schema))
    monkeypatch.setattr(language_id, "SAMPLE", 180)
    language_id.learn(spark.createDataFrame(many, schema))
    learned = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(900))
    assert [n for n, _ in seen] == [sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in (5, 6)), learned, 180]
    assert all(len(languages) == 90 for _, languages in seen[1:])


def test_tables_are_the_network(network):
    data = np.frombuffer(prose(3, 200).encode() * 3, np.uint8)
    offsets = np.array([0, 5, 5, 300, len(data)])
    rows, text, size = language_id.windows_of(data, offsets, language_id.LENGTH, max(language_id.WIDTHS) - 1)
    assert text.tolist()[:3] == [0, 1, 2] and size[0] == 5 and size[1] == 0
    hidden = []
    for filters, bias in zip(network.filters, network.biases):
        places = rows.shape[1] - len(filters) + 1
        hidden.append((sum(network.embedding[rows[:, j : j + places]] @ filters[j] for j in range(len(filters))) + bias).max(axis=1))
    logits = np.maximum(np.concatenate(hidden, axis=1), 0) @ network.dense + network.offset
    expected = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    assert np.allclose(language_id.Tables(network).probabilities(rows), expected, atol=1e-5)


def test_windows_cover_every_place():
    data = np.arange(1, 200, dtype=np.uint8)
    rows, _, size = language_id.windows_of(data, np.array([0, 199]), 32, 3)
    seen = {(int(a), int(b), int(c)) for row, n in zip(rows, size) for a, b, c in zip(row, row[1:n], row[2:n])}
    assert seen == {(i, i + 1, i + 2) for i in range(1, 198)}


def test_attention_scores_each_symbol_once_from_before():
    rng = np.random.default_rng(2)
    first = np.cumsum([0, 5, 0, 32, 33, 100, 1])
    sequence = np.tile(np.arange(7), 40)[: first[-1]].astype(np.int64)
    model = attention.train(sequence, first, 8, np.zeros(8), steps=150)
    found = model.score(sequence, first, run=3)
    assert np.isfinite(found).all() and found[-90:-20].mean() > -0.7  # the cycle is learned
    for s, e in zip(first, first[1:]):
        for at in range(s, e):
            if at - s < attention.WINDOW:
                begin = s
            else:
                begin = s + (-(-(at - s + 1 - attention.WINDOW) // attention.STEP)) * attention.STEP
            given = np.array([8 if k == s else sequence[k - 1] for k in range(begin, at + 1)])
            logits = model._hidden(given[None])[-1][0, -1] @ model.head + model.offset
            expected = logits[sequence[at]] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
            assert abs(found[at] - expected) < 1e-3
    # probabilities add up to one, and what comes later changes nothing
    total = sum(np.exp(model.log_probabilities(np.array([[8, 1, 2]]), np.array([[0, 0, c]]), 2)[0, 0]) for c in range(8))
    assert abs(total - 1) < 1e-5
    assert np.allclose(model.score(sequence[:50], np.array([0, 50]))[:20], model.score(np.append(sequence[:20], rng.integers(0, 7, 30)), np.array([0, 50]))[:20], atol=1e-5)


def _base(rows):
    texts = [words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for _, t in rows]
    rest = [None if i is None else zlib.crc32(str(i).encode()) % 7 for i, _ in rows]
    counts, learned = Counter(), 0
    for found, r in zip(texts, rest):
        if r is not None and r != 2:
            counts.update(found)
            learned += 1
    n, v = sum(counts.values()) + learned, len(counts) + (learned > 0)
    out = []
    for (i, _), found, r in zip(rows, texts, rest):
        each = [counts[w] for w in found] + [learned]
        out.append((i, r == 2, len(each), sum(c > 0 for c in each), n, round(sum(math.log10((c + 1) / (n + v + 1)) for c in each), 5)))
    return out


@pytest.mark.parametrize("file_bytes, bucket", [(6_000_000, 2_000_000), (4000, 40)])
def test_scores_of_awkward_rows(spark, file_bytes, bucket):
    rows = awkward_rows()
    found = language_model.score_texts(table(spark), TOKENIZER, file_bytes=file_bytes, words_per_bucket=bucket).collect()
    assert multiset((*tuple(r)[:5], round(r["base_score"], 5)) for r in found) == multiset(_base(rows))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    # the mean of the model's and the base's probability of a word is at least half the base's
    assert all(r["score"] >= r["base_score"] - r["n_tokens"] * math.log10(2) - 1e-6 for r in found)


def test_scores_with_nothing_to_learn_from(spark):
    held_out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    found = language_model.score_texts(table(spark, [(i, "a b") for i in held_out]), TOKENIZER).collect()
    assert {tuple(r)[1:6] for r in found} == {(True, 3, 0, 0, 0.0)} and all(math.isfinite(r["score"]) for r in found)
    assert language_model.score_texts(table(spark, []), TOKENIZER).count() == 0


CYCLES = ("one two three four five six ", "red green blue white black brown ")


def _score_of_cycles(spark, learned, **sizes):
    """log10 probabilities a word of held-out texts that go through either cycle."""
    held_out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    free = [i for i in range(1000, 3000) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows = [*zip(free, learned), *zip(held_out, (c * 20 for c in CYCLES))]
    found = language_model.score_texts(table(spark, rows), TOKENIZER, **sizes).where("held_out").orderBy("doc_id").collect()
    return [r["score"] / r["n_tokens"] for r in found]


def test_model_learns_from_every_place_of_a_long_text(spark):
    # a piece of the text would show one of the cycles only
    assert min(_score_of_cycles(spark, ["".join(c * 3000 for c in CYCLES)])) > -0.6


def test_model_learns_in_rounds_of_files(spark, monkeypatch):
    monkeypatch.setattr(language_model, "RUN_TOKENS", 10_000)
    assert min(_score_of_cycles(spark, [CYCLES[i % 2] * 150 for i in range(60)], file_bytes=6000)) > -0.6


def test_ids_of_words_that_share_a_slot(monkeypatch):
    monkeypatch.setattr(language_model, "_SLOT_BITS", 3)
    word_ids, rng = language_model.WordIds(TOKENIZER), np.random.default_rng(4)
    vocabulary = ["a", "the", "token", "straße", "supercalifragilisticexpialidocious" * 4, "été", "b", "words", "\u00a0", "#1"]
    for _ in range(6):
        words = sorted({vocabulary[i] for i in rng.integers(0, len(vocabulary), 6)})
        hashes = np.array([zlib.crc32(w.encode()) << 32 for w in words], np.uint64)
        order = np.argsort(hashes)
        words = [words[i] for i in order]
        ids, first = word_ids(hashes[order], lambda places: [words[i] for i in places])
        expected = token_ids(TOKENIZER).encode(words)
        assert [ids[a:b].astype("<u4").tobytes() for a, b in zip(first, first[1:])] == expected


@pytest.mark.parametrize("size", [1, 30])
def test_attention_gradients(size):
    rng = np.random.default_rng(6)
    model = attention.begun(5, np.log(np.full(5, 0.2)))
    model = attention.unpacked(model, attention.packed(model) * size)
    x, y = rng.integers(0, 6, (3, 7)), rng.integers(0, 5, (3, 7))
    h, *_, out = model._hidden(x)
    logits = (out @ model.head + model.offset).astype(np.float64)
    logits -= logits.max(axis=2, keepdims=True)
    expected = np.take_along_axis(logits, y[..., None], 2)[..., 0] - np.log(np.exp(logits).sum(axis=2))
    assert np.allclose(model.log_probabilities(x, y, 0), expected, atol=1e-3, rtol=1e-3)  # large weights overflow nothing
    inside, flat = rng.random((3, 7)) < 0.7, attention.packed(model)
    found = np.concatenate([np.ravel(g) for g in attention._Gradients(model)(x, y, inside)])
    assert np.isfinite(found).all()
    if size == 1:
        for place in rng.integers(0, len(flat), 60):
            loss = []
            for step in (-1e-2, 1e-2):
                moved = flat.copy()
                moved[place] += step
                loss.append(-attention.unpacked(model, moved).log_probabilities(x, y, 0)[inside].mean())
            assert abs((loss[1] - loss[0]) / 2e-2 - found[place]) < 1e-3


def test_model_is_better_than_its_base_on_held_out_texts(spark):
    import __spark_entry__ as entry

    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = entry.queries()["op10_attention_scores"](spark, SF).collect()
    assert multiset((*tuple(r)[:5], round(r["base_score"], 5)) for r in found) == multiset(_base([tuple(r) for r in rows]))
    held_out = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held_out) > sum(r["base_score"] for r in held_out)
