"""Operator 7: numbers of tokens, most words being looked up instead of merged.

Before any text is read, each vocabulary string that can stand as a whole pre-token is encoded alone; those that come out as
exactly their own id are proven. A text is cut at white space, each distinct word is split into the file's pre-tokens, and proven
pre-tokens count one. The library merges only the rest. Words with characters beyond Latin letters (whose classes may differ between
Unicode versions), and words that hold the mark of a special token, are given to the library whole.

The shortcut is for files that drop white space and split by a pattern; sentencepiece models and other files are counted by their
libraries. Null texts are empty and count 0. Null and equal ids keep their rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from keyrill.llm.common import slices, texts
from keyrill.llm.tokenizing import Cutter, load

_MOST = 500_000
_LONG = 128


def _letters_of_bytes() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class WholeTokens:
    """Counts of words for a file that drops white space. `proven` holds the pre-tokens that are one token."""

    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.pattern = regex.compile(parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = [t["content"] for t in parts["added_tokens"]]
        self.suffix = parts["model"]["end_of_word_suffix"] or ""
        self.proven = self._prove()
        self.known: dict[str, int] = {"": 0}

    def _prove(self) -> frozenset[str]:
        alphabet, claims = _letters_of_bytes(), []
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            if token.endswith(self.suffix) and len(token) > len(self.suffix):
                try:
                    claims.append((bytes(alphabet[c] for c in token.removesuffix(self.suffix)).decode(), number))
                except (KeyError, UnicodeDecodeError):
                    continue
        found = self.tokenizer.encode_batch_fast([word for word, _ in claims], add_special_tokens=False)
        return frozenset(word for (word, number), e in zip(claims, found) if e.ids == [number] and self.pattern.fullmatch(word))

    def _count(self, words: list[str]) -> list[int]:
        counts, rest = [0] * len(words), []
        for i, word in enumerate(words):
            if any(c > "ɏ" for c in word) or any(s in word for s in self.special):
                rest.append((i, word))
                continue
            folded = "".join(c.lower() for c in unicodedata.normalize("NFC", word))
            for part in self.pattern.findall(folded):
                if part in self.proven:
                    counts[i] += 1
                else:
                    rest.append((i, part))
        for start in range(0, len(rest), 4096):
            some = rest[start : start + 4096]
            for (i, _), found in zip(some, self.tokenizer.encode_batch_fast([part for _, part in some], add_special_tokens=False)):
                counts[i] += len(found)
        return counts

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > _MOST:
            self.known = {"": 0}
        cut = [text.replace("\n", " ").split(" ") for text in texts]
        new = list(set().union(*cut).difference(self.known))
        counts = dict(zip(new, self._count(new)))
        result = None
        if any(len(word) > _LONG for word in new):
            every = self.known | counts
            result = [sum(map(every.__getitem__, words)) for words in cut]
            counts = {word: n for word, n in counts.items() if len(word) <= _LONG}
        self.known.update(counts)
        return result or [sum(map(self.known.__getitem__, words)) for words in cut]


class _Library:
    """Counts whole texts with the file's own library."""

    def __init__(self, path: str) -> None:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            model = load(path)
            self.count = lambda texts: [len(found) for found in model.encode_batch_fast(texts, add_special_tokens=False)]


_counters: dict[str, WholeTokens | _Library] = {}


def counter(path: str) -> WholeTokens | _Library:
    if path not in _counters:
        shortcut = not path.endswith(".model") and Cutter(path).kind == "dropped"
        _counters[path] = WholeTokens(path) if shortcut else _Library(path)
    return _counters[path]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text; no shuffle."""

    def count(batches):
        count = counter(tokenizer).count
        for batch in batches:
            for part in slices(batch):
                text = part.column("text")
                tokens = pa.array(count(text.to_pylist()), pa.int64())
                columns = [part.column("doc_id"), pc.binary_length(text).cast(pa.int64()), tokens, pc.greater(tokens, limit)]
                yield pa.record_batch(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts(docs).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
