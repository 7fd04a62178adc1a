"""Sequence files, token counts and packing against the tokenizers themselves."""

import random

import numpy as np
import public_tokenizers
import pytest

from keyrill.llm import language_model, packing, sequence_files, token_counts, tokenizing
from keyrill.streaming.jobs import work_folder
from tests.llm.helpers import SF, awkward_rows, crc, multiset, table

WORDS, BYTES = (public_tokenizers.path(f"{name}.json") for name in ("word_bpe_49k", "byte_bpe_50k"))


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_are_the_library_s(path):
    rng = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\t", "\x1c", "'s", "é", "é", "Σ", "İ", "ŉ", "5", "!", ",", ". ", "<|endoftext|>", "<|", "\r\n", "日本", "　", "x" * 200, "word, next. "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3000)] + [t or "" for _, t in awkward_rows()]
    encoder = tokenizing.TokenIds(path, most_bytes=20_000)
    expected = [crc(e.ids) for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 400):
        found = [crc(np.frombuffer(ids, "<u4")) for ids in encoder.encode(texts[at : at + 400])]
        assert found == expected[at : at + 400]


def _expected(path, rows, end=(2,)):
    encoder = tokenizing.load(path)
    return [(i, e.ids + list(end)) for (i, _), e in zip(rows, encoder.encode_batch_fast([t or "" for _, t in rows], add_special_tokens=False))]


def test_sequence_files(spark):
    rows = awkward_rows()
    encoding = sequence_files.Encoding(WORDS, length=64, file_tokens=3000)
    manifest = sequence_files.write_sequences(table(spark), work_folder(spark, "sequences"), encoding)
    found = sequence_files.read_documents(manifest).collect()
    expected = _expected(WORDS, rows)
    assert multiset((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == multiset((i, len(ids), crc(ids)) for i, ids in expected)
    at, last = 0, -1
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        assert last <= (-1 if r["doc_id"] is None else r["doc_id"])
        at, last = at + r["n_tokens"], -1 if r["doc_id"] is None else r["doc_id"]
    files = manifest.orderBy("before").collect()
    assert len(files) > 3
    stream = []
    for f in files:
        file = sequence_files.SequenceFile(f["file"])
        row, mask = file[0]
        assert len(row) == len(mask) == 64 and not row.flags.owndata
        tokens = np.concatenate([file[k][0][file[k][1] == 1] for k in range(len(file))])
        assert len(tokens) == f["tokens"] and -(-f["tokens"] // 64) == len(file)
        assert np.array_equal(tokens, np.concatenate(list(file.tokens(0, len(tokens)))))
        stream.append(tokens)
    by_start = {r["start"]: r for r in found}
    stream = np.concatenate(stream)
    assert all(crc(stream[s : s + r["n_tokens"]]) == r["ids_crc32"] for s, r in by_start.items())
    sequences = sequence_files.read_sequences(manifest)
    assert sequences.count() == sum(-(-f["tokens"] // 64) for f in files)


def test_sequence_files_of_nothing(spark):
    manifest = sequence_files.write_sequences(table(spark, []), work_folder(spark, "sequences"), sequence_files.Encoding(WORDS))
    assert manifest.count() == 0 and sequence_files.read_documents(manifest).count() == 0


def test_sequence_file_random_access(tmp_path):
    writer = sequence_files.SequenceWriter(f"file://{tmp_path}/a/one.arrows", length=8, wide=True, rows=4)
    documents = [np.arange(n, dtype="<u4") + 70_000 * n for n in (3, 0, 50, 9, 1)]
    for number, ids in enumerate(documents):
        writer.add(number, ids)
    writer.close()
    file = sequence_files.SequenceFile(f"{tmp_path}/a/one.arrows")
    every = np.concatenate(documents)
    for number in range(len(file)):
        ids, mask = file[number]
        assert np.array_equal(ids[mask == 1], every[8 * number : 8 * number + 8])


def test_token_counts(spark):
    rows = awkward_rows()
    found = token_counts.token_counts(table(spark), WORDS, limit=100).collect()
    expected = _expected(WORDS, rows, end=())
    sizes = [len((t or "").encode()) for _, t in rows]
    assert multiset(found) == multiset((i, n, len(ids), len(ids) > 100) for (i, ids), n in zip(expected, sizes))
    assert token_counts.token_counts(table(spark, []), WORDS).count() == 0


def test_whole_tokens_are_proven():
    whole = token_counts.WholeTokens(WORDS)
    assert "the" in whole.proven and "<|endoftext|>" not in whole.proven
    texts = ["The THE the. it's", "ÉTÉ éte", "<|endoftext|>", "a" * 300, "ſ K Å ǅ"]
    library = tokenizing.load(WORDS)
    assert whole.count(texts) == [len(library.encode(t, add_special_tokens=False)) for t in texts]


def test_counts_of_a_sentencepiece_model(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = token_counts.token_counts(table(spark), path).collect()
    assert multiset((r["doc_id"], r["n_tokens"]) for r in found) == multiset((i, len(model.encode(t or ""))) for i, t in awkward_rows())


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_packing(spark, block):
    rows, length = awkward_rows(), 64
    pieces = packing.document_pieces(table(spark), BYTES, length=length)
    found = packing.pack_pieces(pieces, length, block).collect()
    expected = []
    for i, ids in _expected(BYTES, rows):
        cuts = [0, *range(len(ids) % length or min(length, len(ids)), len(ids) + 1, length)]
        expected += [(i, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert multiset(tuple(r)[:5] for r in found) == multiset(expected)
    fills = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fills.get(r["sequence_id"], 0)
        fills[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fills.values()) <= length
    least = -(-sum(p[3] for p in expected) // length)
    assert len(fills) <= (least + 2 if block > 1000 else 1.2 * least)


def test_packing_of_nothing(spark):
    assert packing.packed_documents(table(spark, []), BYTES).count() == 0


def test_best_fit_chooses_the_fullest_bin():
    bins, offsets, fills = packing.best_fit(np.array([5, 6, 4, 3, 2]), 10)
    assert fills.tolist() == [10, 10] and sorted(bins.tolist()) == [0, 0, 1, 1, 1]
    assert offsets[bins == bins[1]].tolist() == [0, 6]


def test_registered_queries(spark):
    import __spark_entry__ as entry

    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    found = entry.queries()["op1_sequence_files"](spark, SF).orderBy("doc_id").collect()
    expected = _expected(WORDS, rows)
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found] == [(i, len(x), crc(x)) for i, x in expected]
    assert entry.queries()["op7_token_counts"](spark, SF).count() == len(rows)
    packed = entry.queries()["op9_best_fit_packing"](spark, SF).collect()
    total = sum(len(x) for _, x in _expected(BYTES, rows))
    assert len({r["sequence_id"] for r in packed}) <= -(-total // 1024) + 2


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_words_as_the_library_gives_them(path):
    rng = random.Random(5)
    letters = "abcxyzéñßüžłÉÀİıſƀɏɐ×÷ªµº.,!?;:#$%&*'<>|-_0123中文́ ​ǅ"
    found = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(3000)]
    found += ["".join(rng.choices("abcdeéñüßÉ", k=rng.randint(1, 9))) + rng.choice(["", ".", ",", "***", ".$$$", "!!", "'s", "<|endoftext|>"]) for _ in range(3000)]
    found += ["<|endoftext|>", "it's", "é" * 300, "a" * 5000]
    rng.shuffle(found)
    ids, first = tokenizing.TokenIds(path).encode_words(found)
    expected = tokenizing.load(path).encode_batch(found, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [e.ids for e in expected]
    assert [a.tolist() for a in tokenizing.TokenIds(path).encode_words([])] == [[], [0]]


def test_plain_words_are_encoded_in_rows(monkeypatch):
    one_by_one = []
    monkeypatch.setattr(tokenizing.TokenIds, "_looked_up", lambda self, keys, plain=tokenizing.TokenIds._looked_up: one_by_one.extend(keys) or plain(self, keys))
    plain = [f"{a}{b}é{mark}" for a in "abcdefgh" for b in "ijklmnopÉ" for mark in ("", ".", ",***")]
    language_model.WordIds(WORDS)(np.arange(len(plain) + 1, dtype=np.uint64) << np.uint64(50), lambda places: [[*plain, "it's"][i] for i in places])
    assert one_by_one == ["it's"]


def test_distinct_hashes():
    rng = np.random.default_rng(3)
    for hashes in (rng.integers(0, 1 << 63, 50, dtype=np.uint64)[rng.integers(0, 50, 400)], np.zeros(0, np.uint64)):
        expected = np.unique(hashes, return_index=True, return_inverse=True)
        assert all(np.array_equal(a, b) for a, b in zip(language_model._distinct(hashes), expected))
