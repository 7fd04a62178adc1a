"""Operator 2: leaked benchmark items, also with other numbers, names and units. DataFrame functions only.

Numbers, units after numbers, and names (capitalised words in mid-sentence) become typed placeholders, the rest lower-case words: the
template of a text. Items are cut into all their windows of `size` template tokens, documents into the consecutive windows that
do not overlap, so that any passage of 2 * size - 1 tokens holds one whole window of the document. These meet on their hashes. The few
documents that hit are then looked at in full: all their windows are compared with the items', token by token. Windows of one
document and item that match at the same distance are one passage. It is a leak if it covers `least` tokens (or the whole of a shorter
item) and its slots are consistent: one value of the item always stands for one value of the document, and the other way round.

Windows count whatever they hold, so that an item copied word for word is found wherever it stands; but a passage with
fewer than one word of its own in OWN_SHARE covered tokens is a leak only if it has the item's values. Items of fewer than 2 * size - 1 tokens
use shorter windows, down to SHORTEST tokens; items of fewer than 2 * SHORTEST - 1 tokens are no passages and are not searched for. Items with the same template and the
same pattern of equal slots are one, named by the smallest item_id.

Null texts are empty. Rows are told apart by (doc_id, hash of the text), so a null id is a name like any other, and repeated rows give one
result. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.llm.common import stored

SIZE = 6
LEAST = 13
OWN_SHARE = 4  # one covered token in so many must be a word of its own, unless all values are the item's
SHORTEST = 3
BROADCAST_ROWS = 1_000_000
# fixed values: units that may follow a number
UNITS = (
    "mm cm m km in inch inches ft feet yd yards mi mile miles mg g kg lb lbs pounds oz ounces t tons ml l liter liters litre litres "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "percent degrees dollars dollar euros euro cents cent usd eur gbp kmh mph watts volts joules"
).split()
_MARK = "\u0001"
_NUMBER = r"\p{N}+(?:[.,:/]\p{N}+)*"
_UNIT = rf"(?i)({_MARK}n\S* +)({'|'.join(sorted(UNITS, key=len, reverse=True))})\b"
_NAME = r"\p{Lu}(?<=[\p{Ll}\p{N},;] \p{Lu})[\p{L}'’]+"
_TOKEN = rf"{_MARK}[^\s{_MARK}]+|[\p{{L}}\p{{N}}]+"


def tokens(text: Column, values: bool) -> Column:
    """The template tokens of a text: words, and marks of a slot's type, followed by its value if `values`."""
    value = lambda group: f"${group}" if values else ""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")
    text = F.regexp_replace(text, _NUMBER, f" {_MARK}n{value(0)} ")
    text = F.regexp_replace(text, _UNIT, f"$1{_MARK}u{value(2)} ")
    text = F.regexp_replace(text, _NAME, f" {_MARK}m{value(0)} ")
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))


def _is_slot(token: Column) -> Column:
    return F.startswith(token, F.lit(_MARK))


def _template(found: Column) -> Column:
    return F.transform(found, lambda t: F.when(_is_slot(t), F.substring(t, 1, 2)).otherwise(t))


def _items(benchmark: DataFrame, size: int, shortest: int) -> DataFrame:
    """(item_id, found, template, width) of distinct items; found holds slot values, width is that of the item's windows."""
    items = benchmark.select("item_id", tokens(F.col("text"), values=True).alias("found"))
    items = items.withColumn("template", _template(F.col("found")))
    width = F.least(F.lit(size), F.floor((F.size("found") + 1) / 2)).cast("int")
    pattern = F.transform("found", lambda t: F.when(_is_slot(t), F.array_position("found", t)))
    items = items.withColumn("width", width).withColumn("pattern", pattern).where(F.col("width") >= shortest)
    return items.groupBy("template", "pattern", "width").agg(F.min("item_id").alias("item_id"), F.min_by("found", "item_id").alias("kept"), F.first("found").alias("any")).select(
        "item_id", F.coalesce("kept", "any").alias("found"), "template", "width"
    )


def _item_windows(items: DataFrame) -> DataFrame:
    """(width, hash, item_id, at, words, values, own) of each window; `own` are the places in the item of its words that are no slots."""
    places = F.explode(F.sequence(F.lit(0), F.size("found") - F.col("width")))
    rows = items.select("item_id", "found", "template", "width", F.size("found").alias("item_tokens"), places.alias("at"))
    rows = rows.select(
        "item_id", "item_tokens", "width", "at", F.slice("template", F.col("at") + 1, F.col("width")).alias("words"), F.slice("found", F.col("at") + 1, F.col("width")).alias("values")
    )
    own = F.filter(F.transform("words", lambda t, i: F.when(~_is_slot(t), F.col("at") + i)), lambda p: p.isNotNull())
    return rows.withColumns({"own": own, "hash": F.xxhash64("words")})


def _sent(small: DataFrame, rows: int) -> DataFrame:
    """A table of hashes and ids is broadcast up to a number of rows that makes it some tens of megabytes."""
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, least: int = LEAST, shortest: int = SHORTEST) -> DataFrame:
    """(doc_id, text_hash, item_id, matched_tokens, item_tokens, n_slots, exact) of each document and leaked item.

    exact: all slots have the item's own values.
    """
    windows = stored(_item_windows(_items(benchmark, size, shortest)), "item-windows")
    hashes = windows.select("width", "hash").distinct()
    widths = sorted(r["width"] for r in hashes.select("width").distinct().collect())  # at most `size` numbers
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash"))

    def blocks(found: Column) -> Column:
        def of(width: int) -> Column:
            numbers = F.when(F.size(found) >= width, F.sequence(F.lit(0), F.floor(F.size(found) / width) - 1))
            return F.transform(
                F.coalesce(numbers, F.array().cast("array<bigint>")),
                lambda i: F.struct(F.lit(width).alias("width"), F.xxhash64(F.slice(found, (i * width + 1).cast("int"), width)).alias("hash")),
            )

        return F.concat(*(of(width) for width in widths))

    if not widths:
        widths = [size]
    # an array of one holds the tokens, so that they are found once a text and not once a window
    probes = F.flatten(F.transform(F.array(tokens(F.col("text"), values=False)), blocks))
    probes = rows.select("doc_id", "text_hash", F.inline(probes))
    hit = probes.join(_sent(hashes, hashes.count()), ["width", "hash"], "left_semi").select("doc_id", "text_hash").distinct()
    hit = stored(hit, "leak-candidates").select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    suspects = rows.join(_sent(hit, hit.count()), same, "left_semi").dropDuplicates(["doc_id", "text_hash"])

    suspects = suspects.select("doc_id", "text_hash", tokens(F.col("text"), values=True).alias("found")).withColumn("template", _template(F.col("found")))
    suspects = suspects.withColumn("width", F.explode(F.array(*map(F.lit, widths)))).where(F.size("found") >= F.col("width"))
    places = F.explode(F.sequence(F.lit(0), F.size("found") - F.col("width"))).alias("place")
    seen = suspects.select("doc_id", "text_hash", "found", "template", "width", places).select(
        "doc_id",
        "text_hash",
        "width",
        "place",
        F.slice("template", F.col("place") + 1, F.col("width")).alias("seen_words"),
        F.slice("found", F.col("place") + 1, F.col("width")).alias("seen_values"),
    )
    met = seen.withColumn("hash", F.xxhash64("seen_words")).join(windows, ["width", "hash"]).where("seen_words = words")
    slots = F.filter(F.arrays_zip("values", "seen_values"), lambda p: _is_slot(p["values"]))
    passages = met.groupBy("doc_id", "text_hash", "item_id", "item_tokens", "width", (F.col("place") - F.col("at")).alias("distance")).agg(
        F.collect_set("at").alias("places"),
        F.array_distinct(F.flatten(F.collect_list(slots))).alias("slots"),
        F.size(F.array_distinct(F.flatten(F.collect_list("own")))).alias("own"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("width") - 1)))))
    one_to_one = (F.size(F.array_distinct("slots.values")) == F.size("slots")) & (F.size(F.array_distinct("slots.seen_values")) == F.size("slots"))
    exact = F.forall("slots", lambda p: p["values"] == p["seen_values"])
    passages = passages.select("doc_id", "text_hash", "item_id", "item_tokens", covered.alias("covered"), F.size("slots").alias("n_slots"), exact.alias("exact"), (one_to_one & (exact | (F.col("own") * OWN_SHARE >= covered))).alias("fits"))
    best = passages.where(F.col("fits") & (F.col("covered") >= F.least(F.lit(least), F.col("item_tokens"))))
    best = best.groupBy("doc_id", "text_hash", "item_id", "item_tokens").agg(F.max(F.struct("covered", "exact", "n_slots")).alias("best"))
    return best.select("doc_id", "text_hash", "item_id", F.col("best.covered").alias("matched_tokens"), "item_tokens", F.col("best.n_slots").alias("n_slots"), F.col("best.exact").alias("exact"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **limits: int) -> DataFrame:
    """The rows of `docs`, all columns, that hold no leaked item."""
    found = leaks(docs, benchmark, **limits).select(F.col("doc_id").alias("__leak_id"), F.col("text_hash").alias("__leak_hash"))
    found = stored(found.distinct(), "leaks")
    same = F.col("doc_id").eqNullSafe(F.col("__leak_id")) & (F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) == F.col("__leak_hash"))
    return docs.join(_sent(found, found.count()), same, "left_anti")
