"""Benchmark decontamination by spaced-seed hashing.

Texts become arrays of token hashes (lower case; runs of letters and digits). Each fixed mask selects
some of the tokens of a span and ignores the others, so that a substituted word at an ignored
place doesn't hide a hit. The hashes of all items' spans are joined with those of all documents'
spans; around each hit, aligned windows are compared token by token, and a document is contaminated
if a window has enough equal tokens.

The documents' side stays in one pass: the hash array of a document stays beside the generated
positions, and hits are verified in place, so only verified hits are shuffled. The items' seeds are
broadcast up to a checked count; beyond it (document, place, seed) rows are shuffled without the arrays, a seed that many
documents hold is dealt anew by adaptive execution, and only documents with a hit get their arrays back.

An item of 9 tokens or more is found whatever one token of any 13 is changed, and with two changed in every 13 unless they fall on all masks
of all its spans.

Defined results: null or token-free texts are clean; items without tokens match nothing; items with
fewer tokens than a span need all of their tokens, in order; equal items count each; a repeated id
gives repeated rows with the union of what its rows hit; a row with a null id stands for its own text. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import row_key, stored

#: 1: the token counts, 0: it is ignored.
MASKS = ("110110011", "101101101", "111001011")
#: Used only where an item has exactly a span's tokens: with MASKS, each of them is ignored by some mask.
ENDS = ("011111111", "111111110")
#: Windows of so many tokens, of which so many must be equal (two substitutions).
WINDOW, EQUAL = 13, 11
#: Seeds are broadcast up to this count (24 bytes each).
BROADCAST_SEEDS = 2_000_000


def tokens(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seed(array: str, at: Column, mask: str, number: int, room: Column) -> Column:
    """The hash of the masked tokens from ``at`` on; null where the span doesn't fit."""
    chosen = [F.get(F.col(array), at + k) for k, c in enumerate(mask) if c == "1"]
    return F.when(at + len(mask) <= room, F.xxhash64(F.lit(number), *chosen))


def seeds(df: DataFrame, masks: list[str]) -> DataFrame:
    """All columns, position ``at`` and ``key`` for each position and mask."""
    at = df.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    keys = F.array(*[seed("h", F.col("at"), m, i, F.col("n")) for i, m in enumerate(masks)])
    return at.withColumn("key", F.explode(keys)).where("key is not null")


def overlap(doc: Column, item: Column, item_at: Column, shift: Column, item_n: Column) -> Column:
    """The most equal tokens in a window of the item that holds the seed, as a share of the window's required count."""
    span = len(MASKS[0])
    width = F.least(F.lit(WINDOW), item_n)
    first = F.greatest(F.lit(0), item_at - (WINDOW - span))
    last = F.least(item_at, item_n - width)
    same = lambda j: F.when(F.get(doc, shift + j) == F.get(item, j), 1).otherwise(0)
    window = lambda s: F.aggregate(F.sequence(s, s + width - 1), F.lit(0), lambda acc, j: acc + same(j))
    return F.array_max(F.transform(F.sequence(F.least(first, last), last), window))


def scan(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """id and item_ids, an ordered array, for every document that an item contaminates."""
    bench = items.select(F.col(item_col).alias("item"), tokens(F.col(item_text).cast("string")).alias("h")).withColumn("n", F.size("h")).where("n > 0")
    bench = stored(bench.groupBy("h", "n").agg(F.sort_array(F.collect_set("item")).alias("items")).withColumn("k", F.monotonically_increasing_id()))
    span = len(MASKS[0])
    sizes = [r.n for r in bench.where(F.col("n") <= span).select("n").distinct().collect()]  # at most span values
    masks = [*MASKS, *(ENDS if span in sizes else ()), *["1" * n for n in sorted(sizes) if n < span]]
    keyed = seeds(bench, masks).where((F.col("n") >= span) | (F.col("at") == 0)).select("key", "k", F.col("at").alias("item_at")).distinct()
    keyed = stored(keyed)
    named = bench.select("k", F.col("h").alias("item_h"), F.col("n").alias("item_n"))
    text = docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col).cast("string")).alias("h")).withColumn("n", F.size("h")).where("n > 0")
    if keyed.count() <= broadcast_seeds:
        hits = seeds(text, masks).join(F.broadcast(keyed), "key").join(F.broadcast(named), "k")
    else:  # only places and keys are shuffled; hit documents get their tokens back
        text = stored(text.withColumn("row", F.monotonically_increasing_id()))
        thin = seeds(text, masks).select("row", "at", "key").join(keyed, "key").select("row", "at", "k", "item_at")
        hits = thin.join(text.select("row", "id", "h"), "row").join(named, "k")
    equal = overlap(F.col("h"), F.col("item_h"), F.col("item_at"), F.col("at") - F.col("item_at"), F.col("item_n"))
    needed = F.when(F.col("item_n") >= WINDOW, EQUAL).when(F.col("item_n") < span, F.col("item_n")).otherwise(F.ceil(F.col("item_n") * EQUAL / WINDOW))
    found = hits.where(equal >= needed).select("id", "k").distinct()
    lists = found.join(bench.select("k", "items"), "k").groupBy("id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"))
    return lists.select(F.col("id").alias(id_col), "item_ids")


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """id, contaminated, n_items and item_ids (comma-joined) for every row of docs."""
    keyed = docs.select(F.col(id_col), F.col(text_col).alias("text_"), row_key(id_col, text_col).alias("key_"))
    found = scan(keyed, items, "key_", "text_", **columns)
    out = keyed.select(id_col, "key_").join(found, "key_", "left")
    return out.select(
        id_col,
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.when(F.col("item_ids").isNull(), 0).otherwise(F.size("item_ids")).cast("long").alias("n_items"),
        F.coalesce(F.array_join(F.col("item_ids").cast("array<string>"), ","), F.lit("")).alias("item_ids"),
    )
