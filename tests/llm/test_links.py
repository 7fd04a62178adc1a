"""Leaked benchmark items, quotations, the pipeline, and what the entry registers."""

import os
import random
import subprocess
import sys

import corpus_pipeline
import duckdb
import pandas as pd
from keyrill.llm import decontamination, quotes, sql
from keyrill.llm.common import stored
from tests.llm.helpers import SF, multiset, prose, table

ITEMS = "item_id long, text string"
APPLES = "Anna has 12 apples and buys 3 more, then she gives {} {} apples at the market in town today."


def _leaks(spark, docs, items, **limits):
    found = decontamination.leaks(table(spark, docs), spark.createDataFrame(items, ITEMS), **limits)
    return multiset((r["doc_id"], r["item_id"], r["exact"]) for r in found.collect())


def test_slots_must_be_consistent(spark):
    item = [(1, APPLES.format("Peter", 12)), (2, "too short"), (3, None), (None, "")]
    other = "Well then. Mary has 7 apples and buys 5 more, then she gives John {} apples at the market in town today. Bye."
    docs = [(1, other.format(7)), (2, other.format(8)), (None, APPLES.format("Peter", 12)), (None, prose(1, 50)), (4, None), (5, "")]
    assert _leaks(spark, docs, item) == multiset([(1, 1, False), (None, 1, True)])
    kept = decontamination.without_leaks(table(spark, docs), spark.createDataFrame(item, ITEMS))
    assert kept.columns == table(spark, []).columns
    assert multiset((r["doc_id"], r["text"]) for r in kept.collect()) == multiset([docs[1], docs[3], docs[4], docs[5]])


def test_passages_at_any_place(spark):
    passage = prose(5, 40)
    docs = [(k, f"{prose(60 + k, 30 + k)} {passage} {prose(90 + k, 25)}") for k in range(14)] + [(50, prose(70, 400)), (51, " ".join(passage.split()[10:26]))]
    assert _leaks(spark, docs, [(9, passage)]) == multiset([(k, 9, True) for k in range(14)] + [(51, 9, True)])


def test_units_short_items_and_equal_items(spark):
    items = [(1, "the long old train travels 300 km in 2 hours from one city to another"), (2, "the long old train travels 300 km in 2 hours from one city to another"), (3, "who wrote this old book"), (4, "7 + 5 = 12")]
    docs = [(1, "The long old train travels 450 miles in 9 minutes from one city to another."), (2, "well who wrote this old book then"), (3, "who wrote that old book"), (4, "7 + 5 = 12")]
    assert _leaks(spark, docs, items) == multiset([(1, 1, False), (2, 3, True)])


def test_repeated_documents_and_empty_tables(spark):
    item = [(1, prose(5, 40))]
    docs = [(1, item[0][1])] * 3 + [(2, f"{item[0][1]} {item[0][1]}")]
    assert _leaks(spark, docs, item) == multiset([(1, 1, True), (2, 1, True)])
    assert not _leaks(spark, [], item) and not _leaks(spark, docs, [])
    assert decontamination.without_leaks(table(spark, docs), spark.createDataFrame(item, ITEMS)).count() == 0


def test_planted_items_are_found(spark):
    import __spark_entry__ as entry

    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    planted = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]}
    found = {(r["doc_id"], r["item_id"]) for r in entry.queries()["op2_decontamination"](spark, SF).collect()}
    assert planted and found == planted


def test_the_plan_of_decontamination_is_native(spark):
    found = decontamination.leaks(table(spark, [(1, "a")]), spark.createDataFrame([(1, prose(1, 30))], ITEMS))
    assert not any(word in found._jdf.queryExecution().toString() for word in ("Python", "Arrow", "Pandas"))


CHAT = "conv_id long, turn int, role string, text string, row long, key string, level int"


def _order(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], CHAT)
    return quotes.reply_order(frame).collect()


def test_reply_order(spark):
    rows = [
        (1, 0, "u", "Hello there.\nHow are you?"),
        (1, 1, "a", "> How are you?\nFine."),
        (1, 2, "u", "Other topic"),
        (1, 3, "u", "On Monday X wrote:\n>> how are YOU\n> Fine\nGreat!"),
        (1, 4, "a", ">other topic.\nYes"),
        (1, 5, "u", "> > Hello   there!\n> > How\n> > are you?\nOn what?"),
        (1, 6, "u", "> never said\nx > y"),
        (2, 0, "u", None),
        (2, 1, "u", "> How are you?"),
        (None, 1, "a", "> x\ny"),
        (3, None, "a", "> x\ny"),
    ]
    found = sorted(_order(spark, rows), key=lambda r: (r["conv_id"] is None, r["conv_id"], r["position"] or 0))
    assert [(r["conv_id"], r["turn"], r["reply_turn"], r["thread_turn"], r["n_linked"], r["position"], r["text"]) for r in found] == [
        (1, 0, None, 0, 0, 1, "Hello there.\nHow are you?"),
        (1, 1, 0, 0, 1, 2, "Fine."),
        (1, 3, 1, 0, 2, 3, "Great!"),
        (1, 5, 0, 0, 1, 4, "On what?"),
        (1, 2, None, 2, 0, 5, "Other topic"),
        (1, 4, 2, 2, 1, 6, "Yes"),
        (1, 6, None, 6, 0, 7, "x > y"),
        (2, 0, None, 0, 0, 1, ""),
        (2, 1, None, 1, 0, 2, ""),
        (3, None, None, None, 0, None, "y"),
        (None, 1, None, 1, 0, None, "y"),
    ]


def test_repeated_turns_and_long_threads(spark):
    rows = [(1, t, "u", f"> line {t - 1} is here\nline {t} is here" if t else "line 0 is here") for t in range(40)]
    rows += [rows[7], rows[7]]
    found = sorted(_order(spark, rows), key=lambda r: r["position"])
    assert [r["position"] for r in found] == list(range(1, 43))
    assert all(r["thread_turn"] == 0 and r["reply_turn"] == (r["turn"] - 1 if r["turn"] else None) for r in found)
    assert _order(spark, []) == []


def _quoting(seed, turns=25):
    """A conversation whose messages quote passages and sentences of others, wrapped anew, at several levels."""
    rng = random.Random(seed)
    rows, said = [], []
    for turn in range(turns):
        lines = []
        for _ in range(rng.randrange(4)):
            marks = "> " * rng.choice([1, 1, 2]) if rng.random() < 0.8 else ">>"
            if said and rng.random() < 0.8:
                passage = rng.choice(said)
                passage = rng.choice([passage, passage.upper(), rng.choice(passage.split(". ")), passage.replace(" ", "  ")]).split()
            else:
                passage = prose(rng.random(), rng.randrange(1, 9)).split()
            if rng.random() < 0.3:
                lines.append(marks.replace(">", "", 1).strip() + "On Monday X wrote:")
            width = rng.randrange(1, 7)
            lines += [marks + " ".join(passage[i : i + width]) for i in range(0, len(passage), width)]
            lines += rng.choice([[], [""], [marks]])
        for _ in range(rng.randrange(3)):
            passage = ". ".join(prose(rng.random(), rng.randrange(1, 6), 40) for _ in range(rng.randrange(1, 4)))
            said.append(rng.choice([passage, "thanks"]))
            lines += [said[-1], ""] if rng.random() < 0.9 else [said[-1], "On we go"]
        rows.append((seed % 7, turn + 100 * (seed // 7), rng.choice("ua"), "\n".join(lines) if rng.random() < 0.95 else None))
    return rows


def test_replies_are_those_of_the_sql(spark):
    rows = [row for seed in range(21) for row in _quoting(seed)] + [(None, 1, "u", "> thanks\nx"), (3, None, "u", "> thanks\nx"), (99, 0, None, "")]
    found = multiset(tuple(r) for r in _order(spark, rows))
    db = duckdb.connect()
    db.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    expected = db.sql(f"SELECT conv_id, turn, role, reply_turn, thread_turn, n_linked, position, text FROM ({sql.ORACLES['op3_quotation_linking']})").fetchall()
    assert found == multiset(expected)
    assert sum(r[3] is not None for r in expected) > 100 and any(r[5] > 2 for r in expected)


def test_conversations_without_quotes_keep_their_turns(spark):
    import __spark_entry__ as entry

    found = entry.queries()["op3_quotation_linking"](spark, SF).collect()
    given = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    assert multiset((r["conv_id"], r["turn"], r["text"]) for r in found) == multiset((r["conv_id"], r["turn"], r["text"]) for r in given)


def test_pipeline_stages_take_effect(spark):
    from keyrill.llm import packing, quality, simhash, substrings

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    judged = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        counts.append(docs.count())
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if number == 0:
            assert ids == {i for i, kept in judged.items() if kept}
        elif number == 1:
            assert ids == {r["component_id"] for r in simhash.near_duplicates(before).collect()}
        elif number == 2:
            assert all(r["n_removed"] == 0 or r["document"]["doc_id"] in ids for r in substrings.repeated_spans(before).collect())
            assert counts[-1] == counts[-2]
        else:
            leaked = {r["doc_id"] for r in decontamination.leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert ids == {r["doc_id"] for r in before.collect()} - leaked
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == ids and len(packed) >= counts[-1]
    assert len([name for name, _ in corpus_pipeline.STAGES]) == 5 and packing.NEARLY_FULL < 1


def test_entry_without_this_part(tmp_path):
    """The entry still imports where these folders and the pipeline are gone."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (
        "import importlib.util as u, sys\n"
        "real = u.find_spec\n"
        "u.find_spec = lambda name, *a: None if name in ('keyrill.llm', 'corpus_pipeline') else real(name, *a)\n"
        f"sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "assert not any(n.startswith('op') and '_' in n and n[2].isdigit() or n == 'pipeline' for n in e.queries())\n"
        "assert len(e.queries()) > 50 and set(e.oracle_sql()) <= set(e.queries())"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)


def test_items_copied_word_for_word_are_found_wherever_they_stand(spark):
    """Random items, some of them mostly numbers, at random places in prose; a document without any is left alone."""
    rng = random.Random(8)
    stems = [f"{a}{b}{c}" for a in ("ba", "di", "ko", "mu") for b in ("ren", "sot", "lip", "gav") for c in ("e", "o", "y")]

    def item():
        return " ".join(rng.choice(stems) if rng.random() < 0.55 else str(rng.randrange(1000)) for _ in range(rng.randint(5, 24)))

    items = list(dict.fromkeys(["what is 7 plus 8", "boxes holding 12 , 13 , 14 , 15 , 16 , 17 apples reach market before noon", *(item() for _ in range(60))]))
    rows = []
    for number, text in enumerate(items):
        for copy in range(4):
            rows.append((10 * number + copy, f"{prose(number, rng.randint(0, 30))} {text} {prose(number + 500, rng.randint(0, 30))}", number))
    rows += [(9000 + i, prose(9000 + i, 80), None) for i in range(20)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, benchmark).collect()}
    templates = {}
    for number, text in enumerate(items):  # items of one template are one
        tokens = [t if t.isalpha() else "#" for t in text.replace(",", " ").split()]
        values = [t for t in text.replace(",", " ").split()]
        templates.setdefault((tuple(tokens), tuple(values.index(v) for v, t in zip(values, tokens) if t == "#")), number)
    named = {n: templates[k] for k in templates for n in [templates[k]]}
    missing = [(d, n) for d, _, n in rows if n is not None and n in named and (d, n) not in found]
    assert missing == []
    assert not [d for d, _ in found if d >= 9000]
