"""Token ids of whole texts exactly as the tokenizers library gives them, each distinct word being encoded once.

Two kinds of files are known to never let a token cross certain white space, so that texts can be cut there and the
ids of the parts put together again:

* white space dropped before the merges: any space or line feed is a cut;
* a byte-level pattern that draws one space to the next word: a cut lies before a space or line feed with no other
  white space beside it.

Texts for files of any other kind are encoded whole. Strings of special tokens hold no white space and so never cross a cut.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from keyrill.llm.common import held

_BESIDE = re.compile(r"\s\s")
_CUTS = re.compile(r"(?<=\S)(?=[ \n]\S)")
_TAILS = (",", ".")
# all that any library takes for white space, twice: texts with none of it are cut as columns
_BESIDE_ALL = r"[\s\v\x{1c}-\x{1f}\x{85}\pZ]{2}"
_ENTRY = 200
MOST_BYTES = 120_000_000
_LONG = 128
_JOINED = 64
_LETTER, _MARK, _LEAD, _REST, _SPACE = 1, 2, 3, 4, 5
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = _LETTER
_CLASS[0xC3:0xCA] = _LEAD  # of U+00C0 to U+027F
_CLASS[0x80:0xC0] = _REST
_CLASS[ord(" ")] = _SPACE


def load(path: str):
    """The tokenizer of a file, running on the calling thread only."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _kind(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    added = all(not t["lstrip"] and not t["rstrip"] and not t["normalized"] and not re.search(r"\s", t["content"]) for t in parts["added_tokens"])
    splitter, normalizer = parts["pre_tokenizer"] or {}, parts["normalizer"]
    if not added:
        return "whole"
    if splitter.get("type") == "ByteLevel" and splitter["use_regex"] and not splitter["add_prefix_space"] and normalizer is None:
        return "led"
    steps = splitter.get("pretokenizers", [{}])
    dropped = steps[0].get("type") == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and r"[^\s\p{L}\p{N}]+" in steps[0]["pattern"].get("Regex", "")
    plain = {step["type"] for step in (normalizer or {}).get("normalizers", [])} <= {"NFC", "Replace", "Lowercase"}
    return "dropped" if dropped and plain and not any(step.get("add_prefix_space") for step in steps) else "whole"


def _suffix(path: str) -> str | None:
    with open(path, encoding="utf-8") as file:
        return json.load(file)["model"].get("end_of_word_suffix")


def _bare(path: str, tokenizer):
    """The tokenizer of a file without its normalizer, for words that this would only put in lower case; None if that is not known."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        steps = (json.load(file)["normalizer"] or {}).get("normalizers", [{}])
    spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    known = steps[-1:] == [{"type": "Lowercase"}] and all(step in ({"type": "NFC"}, spaces) for step in steps[:-1])
    if not known or any(t.content.isalpha() for t in tokenizer.get_added_tokens_decoder().values()):
        return None
    bare = Tokenizer(tokenizer.model)
    bare.pre_tokenizer = tokenizer.pre_tokenizer
    return bare


def _large(lists: pa.Array) -> pa.LargeListArray:
    """Lists of large strings whose values are just those of the lists."""
    lists = lists.cast(pa.large_list(pa.large_string()))
    offsets = lists.offsets.to_numpy()
    return pa.LargeListArray.from_arrays(pa.array(offsets - offsets[0] if len(offsets) else [0]), lists.flatten())


class Cutter:
    """Cuts texts into the parts that a file's tokens never cross. Parts are named by keys; `part` gives their text."""

    def __init__(self, path: str) -> None:
        self.kind = _kind(path)

    def keys(self, text: str) -> list[str]:
        if self.kind == "dropped":
            return text.replace("\n", " ").split(" ")
        if self.kind == "whole":
            return [text]
        if _BESIDE.search(text):
            head, *rest = _CUTS.split(text)
            return [f"\n\n{head}", *(part[1:] if part[0] == " " else part for part in rest)]
        keys = text.replace("\n", " \n").split(" ")
        keys[0] = f"\n\n{keys[0]}"
        return keys

    def columns(self, column: pa.Array) -> pa.LargeListArray:
        """The keys of each text of a column: as `keys`, without a Python string for each word."""
        column = column.cast(pa.large_string())
        if self.kind == "whole":
            return pa.LargeListArray.from_arrays(pa.array(range(len(column) + 1), pa.int64()), column)
        if self.kind == "dropped":
            return _large(pc.split_pattern(pc.replace_substring(column, "\n", " "), " "))
        beside = pc.match_substring_regex(column, _BESIDE_ALL).to_numpy(zero_copy_only=False)
        led = pc.binary_join_element_wise(*(pa.scalar(x, pa.large_string()) if isinstance(x, str) else x for x in ("\n\n", pc.replace_substring(column, "\n", " \n"), "")))
        if not beside.any():
            return _large(pc.split_pattern(led, " "))
        split = _large(pc.split_pattern(pc.if_else(pa.array(beside), pa.scalar("", pa.large_string()), led), " "))
        # the few texts with white space side by side are cut one by one
        slow = {i: self.keys(text) for i, text in zip(np.flatnonzero(beside).tolist(), column.filter(pa.array(beside)).to_pylist())}
        offsets, parts, begun = split.offsets.to_numpy(), [], 0
        counts = np.diff(offsets)
        for i, keys in slow.items():
            parts += [split.values.slice(offsets[begun], offsets[i] - offsets[begun]), pa.array(keys, pa.large_string())]
            counts[i], begun = len(keys), i + 1
        parts.append(split.values.slice(offsets[begun], offsets[-1] - offsets[begun]))
        return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)])), pa.concat_arrays(parts))

    def part(self, key: str) -> str:
        """A key stands for itself with a space before it, unless a line feed or (two of them) nothing does."""
        if self.kind != "led":
            return key
        if key.startswith("\n\n"):
            return key[2:]
        return key if key.startswith("\n") else f" {key}"

    def stem(self, key: str) -> str | None:
        """What of a part may be encoded in a row with others, its ids being told from theirs; None for nothing.

        Where white space is dropped, these are Latin letters: one pre-token, whose last id is marked. A comma or full stop after them
        is a pre-token of its own. Where a space is drawn to the next word, it marks a part's first id.
        """
        if self.kind == "dropped":
            stem = key[:-1] if key[-1:] in _TAILS else key
            return stem if stem.isalpha() and (stem.isascii() or max(stem) <= "ɏ") else None
        return key if self.kind == "led" and len(key) <= _LONG and key.isprintable() and " " not in key else None


class TokenIds:
    """Ids as little-endian unsigned 32-bit integers. Remembers the ids of short words, in about `most_bytes` of memory.

    What is remembered are the words met since that memory was last half full, and those of the half before it.
    """

    def __init__(self, path: str, most_bytes: int = MOST_BYTES) -> None:
        self.tokenizer = load(path)
        self.cutter = Cutter(path)
        self.half = most_bytes // 2
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.held = 0
        self.tails = dict(zip(_TAILS, self._alone(list(_TAILS))))
        # ids that end (white space dropped) or begin (drawn to the next word) a part
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.marked = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        suffix = _suffix(path)
        for token, number in vocabulary.items():
            self.marked[number] = token.startswith("Ġ") if self.cutter.kind == "led" else bool(suffix) and token.endswith(suffix)
        self.bare = _bare(path, self.tokenizer) if self.cutter.kind == "dropped" else None
        special = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values()).encode()
        self.classes = _CLASS.copy()
        self.classes[list(set(b".,!?;:#$%&*") - set(special))] = _MARK

    def _joined(self, stems: list[str]) -> dict[str, bytes]:
        """The ids of stems, encoded many at a time, which costs half as much; those that cannot be told apart are left out."""
        ids, last = {}, self.cutter.kind == "dropped"
        for start in range(0, len(stems), 256 * _JOINED):
            groups = [stems[k : k + _JOINED] for k in range(start, min(start + 256 * _JOINED, len(stems)), _JOINED)]
            rows = [" ".join(g) if last else f" {' '.join(g)}" for g in groups]
            for group, found in zip(groups, self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)):
                row = np.array(found.ids, "<u4")
                edges = np.flatnonzero(self.marked[row])
                if len(edges) == len(group):
                    stops = (4 * (edges + 1)).tolist() if last else [*(4 * edges[1:]).tolist(), 4 * len(row)]
                    packed = row.tobytes()
                    ids.update((stem, packed[a:b]) for stem, a, b in zip(group, [0, *stops], stops))
        return ids

    def _alone(self, parts: list[str]) -> list[bytes]:
        ids = []
        for start in range(0, len(parts), 4096):
            found = self.tokenizer.encode_batch_fast(parts[start : start + 4096], add_special_tokens=False)
            ids.extend(np.array(f.ids, "<u4").tobytes() for f in found)
        return ids

    def _encode(self, keys: list[str]) -> dict[str, bytes]:
        stems = list(map(self.cutter.stem, keys))
        joined = self._joined(list(dict.fromkeys(filter(None, stems))))
        ids, alone = {}, []
        for key, stem in zip(keys, stems):
            found = joined.get(stem)
            if found is None:
                alone.append(key)
            else:
                ids[key] = found if len(stem) == len(key) else found + self.tails[key[-1]]
        ids.update(zip(alone, self._alone([self.cutter.part(key) for key in alone])))
        return ids

    def _looked_up(self, keys: list[str]) -> list[bytes]:
        """The ids of distinct keys, from memory or encoded now."""
        found = list(map(self.known.get, keys))
        places = [i for i, ids in enumerate(found) if ids is None]
        if not places:
            return found
        new = [keys[i] for i in places]
        again = list(map(self.before.get, new))
        fresh = self._encode([key for key, ids in zip(new, again) if ids is None])
        again = [fresh[key] if ids is None else ids for key, ids in zip(new, again)]
        for i, ids in zip(places, again):
            found[i] = ids
        self.known.update((key, ids) for key, ids in zip(new, again) if len(key) <= _LONG)
        self.held += _ENTRY * len(new) + min(sum(map(len, new)), _LONG * len(new))
        if self.held > self.half:
            self.known, self.before, self.held = {}, self.known, 0
        return found

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column without nulls, one after the other, and where each text's begin (and the last ends).

        Texts are cut into words as a column, and only distinct words are looked at one by one.
        """
        keys = self.cutter.columns(column)
        distinct = keys.values.dictionary_encode()
        codes = distinct.indices.to_numpy(zero_copy_only=False)
        found = self._looked_up(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(found), "<u4")
        lengths = sizes[codes]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[codes] - (ends - lengths), lengths)
        return ids[at], np.concatenate([[0], ends])[keys.offsets.to_numpy()]

    def _plain(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words, with a space after each, are Latin letters with or without marks after them, and which have marks."""
        kind = self.classes[data]
        before = np.concatenate([[np.uint8(_SPACE)], kind[:-1]])
        lead = np.concatenate([[np.uint8(0)], data[:-1]])
        wrong = (kind == 0) | (kind == _REST) & (before != _LEAD)
        wrong |= (kind == _MARK) & (before == _SPACE) | ((kind == _LETTER) | (kind == _LEAD)) & (before == _MARK)
        # the signs for times and divided by; what comes after U+024F
        wrong |= (lead == 0xC3) & ((data == 0x97) | (data == 0xB7)) | (lead == 0xC9) & (data >= 0x90)
        return ~np.logical_or.reduceat(wrong, begins), before[np.append(begins[1:], len(data)) - 1] == _MARK

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As `encode_column` of texts without a space, none of them empty; those that are not met again cost less here.

        Where white space is dropped, Latin letters are one pre-token and marks after them another, so that rows of many such words are
        encoded at once, without the file's normalizer. Each pre-token ends in a marked id; a row with more of these than expected is
        encoded word by word.
        """
        if self.bare is None or not words:
            return self.encode_column(pa.array(words, pa.large_string()))
        data = np.frombuffer(f"{' '.join(words)} ".encode(), np.uint8)
        begins = np.concatenate([[0], np.flatnonzero(data == ord(" ")) + 1])
        plain, tailed = self._plain(data, begins[:-1])
        places, sizes = np.flatnonzero(plain), np.diff(begins)
        text = data[np.repeat(plain, sizes)].tobytes()
        row_words = [places[k : k + _JOINED] for k in range(0, len(places), _JOINED)]
        stops = np.cumsum([0, *(sizes[row].sum() for row in row_words)]).tolist()
        rows = [text[s : e - 1].decode().lower() for s, e in zip(stops, stops[1:])]
        found, kept = [], []
        for start in range(0, len(rows), 256):
            for row, encoded in zip(row_words[start:], self.bare.encode_batch_fast(rows[start : start + 256], add_special_tokens=False)):
                ids = np.array(encoded.ids, "<u4")
                if np.count_nonzero(self.marked[ids]) == len(row) + np.count_nonzero(tailed[row]):
                    found.append(ids)
                    kept.append(row)
                else:
                    plain[row] = False
        joined = np.concatenate([np.zeros(0, "<u4"), *found])
        places = np.concatenate([np.zeros(0, np.int64), *kept])
        ends = (np.flatnonzero(self.marked[joined]) + 1)[np.cumsum(1 + tailed[places]) - 1]
        rest = np.flatnonzero(~plain)
        rest_ids, rest_first = self.encode_column(pa.array([words[i] for i in rest], pa.large_string()))
        lengths = np.empty(len(words), np.int64)
        lengths[places], lengths[rest] = np.diff(ends, prepend=0), np.diff(rest_first)
        first = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.empty(first[-1], "<u4")
        for some, some_ids in ((places, joined), (rest, rest_ids)):
            n = lengths[some]
            ids[np.repeat(first[some] - (np.cumsum(n) - n), n) + np.arange(len(some_ids))] = some_ids
        return ids, first

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, without special tokens around it."""
        ids, edges = self.encode_column(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def token_ids(path: str, most_bytes: int = MOST_BYTES) -> TokenIds:
    """One per file and Python worker, so that tasks in the same worker share what it remembers."""
    return held("tokens", (path, most_bytes), lambda: TokenIds(path, most_bytes))
