"""Small tables with awkward rows, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# columns that have the names of what operators add inside or return
CLASHES = "doc_id long, text string, lang string, source string, n_chars long, row long, n_words long, c1 string, hash long, width int, fp long, tile long, bin long, file string"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(seed: int, count: int, vocabulary: int = 300) -> str:
    rng = random.Random(seed)
    syllables = ["er", "th", "an", "in", "on", "re", "st", "ou", "le", "ch", "ei", "ä", "é"]
    known = ["".join(random.Random(i).choices(syllables, k=1 + i % 4)) for i in range(vocabulary)]
    out = []
    for _ in range(count):
        word = known[min(vocabulary - 1, int(rng.expovariate(6 / vocabulary)))]
        out.append(word.capitalize() + rng.choice(["", ",", "."]) if rng.random() < 0.2 else word)
        out.append(rng.choice([" ", " ", " ", "\n", "  ", "\t"]))
    return "".join(out)


def awkward_rows() -> list[tuple]:
    """Null, empty and blank texts, null and equal ids, repeated rows, a very long text, copies and near copies."""
    base = [prose(i, 60 + 17 * i % 90) for i in range(30)]
    passage = prose(99, 45)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100, base[3]), (101, base[3]), (101, base[3]), (102, base[4] + " tail"), (None, base[5]), (None, base[5]), (None, prose(7, 50))]
    rows += [(110, f"{prose(41, 30)} {passage} {prose(42, 30)}"), (111, f"{prose(43, 21)} {passage}"), (112, f"{passage}\n{passage}")]
    rows += [(120, None), (121, ""), (122, " \n\t "), (123, "one"), (124, "one two"), (125, "    x\x1cy ퟿ \U0001f600")]
    rows += [(130, prose(50, 6000)), (131, "a" * 3000), (132, "the " * 400), (133, "<|endoftext|> Don't <|startoftext|>ok's 12,5 x")]
    return rows


def table(spark, rows=None):
    rows = awkward_rows() if rows is None else rows
    full = [(i, t, "en", "s", len(t or ""), 1, 2, "c", 3, 4, 5, 6, 7, "f") for i, t in rows]
    return spark.createDataFrame(full, CLASHES)


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def multiset(rows) -> Counter:
    return Counter(map(tuple, rows))
