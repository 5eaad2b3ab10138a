"""Document fingerprints by consistent weighted sampling.

A text's terms are its words (white space apart, lower-cased), weighted by how often they occur. For each of SAMPLES
places, every term draws r and c from Gamma(2, 1) and b from [0, 1), all fixed by the term and the
place; t = floor(ln(weight) / r + b), ln a = ln c - r (t - b) - r, and the term with the least
a is sampled with its t. Two texts agree in a place with a probability that equals their generalised
Jaccard similarity, sum of minima over sum of maxima of weights. A place keeps 16 bits of (term, t).

Gamma(2, 1) is the sum of two exponentials: r = -ln(u1 u2) with uniform u from bits of the term's hash. Words are
counted in both texts of a document at once, so that a term with the same weight in both is sampled once; each term meets all places
as rows, of which only those under a bound that needs no logarithm are computed in full.

Documents are put into blocks of neighbours in their order by bounds from a sample of their keys; the head of the next block
is copied into each block. From there on everything happens within a block, so texts are shuffled once.

Defined results: null texts are empty; an empty text has the fingerprint of zeros; equal texts
have equal fingerprints; documents are ordered by descending id, equal ids by the descending hash of their text and null ids last;
a lone document is its own next; repeated rows give repeated rows. Ids may be of any type that has an order. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 64
#: Places that one long of a fingerprint holds.
LANES = 4
#: The least a of a text is exponential with its total weight as rate: it exceeds SURE over the total in one of 10^8 places, which then reads zero.
SURE = 18.5
#: Documents of a block, about; blocks, at most; and sampled keys for each block.
BLOCK, MOST_BLOCKS, SAMPLED_KEYS = 1024, 16_384, 8


def words(text: Column) -> Column:
    """The lower-cased words of a text."""
    text = F.lower(text)
    for mark in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(mark), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")  # one plain character: no regular expression


def _salt(place: int) -> int:
    """A fixed 63-bit number for each place."""
    return int.from_bytes(hashlib.sha256(f"place {place}".encode()).digest()[:8], "big") >> 1


def uniform(x: Column, shift: int, width: int) -> Column:
    return (F.shiftrightunsigned(x, shift).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(0.5)) * F.lit(2.0**-width)


def sampled(terms: DataFrame, keep: list[str], sure: float = SURE) -> DataFrame:
    """keep, place and value for the (term, weight, total) rows that may have their text's least a in a place.

    value has ln a in the upper 48 bits and 16 bits of (term, t) below. exp(-r) is u1 u2, and c = -ln(u3 u4) is at least
    2 (1 - u3 u4) / (1 + u3 u4), so a is at least c's bound times u1 u2 / weight. A null term gives one row with a null value.
    """
    hashes = F.array(*[F.xxhash64(F.col("term").bitwiseXOR(F.lit(_salt(k)))) for k in range(SAMPLES)])
    rows = terms.select(*keep, "term", "weight", (F.lit(sure) * F.col("weight") / F.greatest("total", F.lit(1))).alias("limit"), F.posexplode(hashes).alias("place", "g"))
    e_r, e_c = uniform(F.col("g"), 44, 20) * uniform(F.col("g"), 32, 12), uniform(F.col("g"), 12, 20) * uniform(F.col("g"), 0, 12)
    rows = rows.where((2 * (1 - e_c) * e_r <= F.col("limit") * (1 + e_c)) | (F.col("term").isNull() & (F.col("place") == 0)))
    rows = rows.select(*keep, "place", "term", F.log(F.col("weight").cast("double")).alias("log_weight"), (-F.log(e_r)).alias("r"), F.log(-F.log(e_c)).alias("log_c"), F.xxhash64("g").alias("h"))
    rows = rows.withColumn("b", uniform(F.col("h"), 32, 32))
    rows = rows.withColumn("t", F.floor(F.col("log_weight") / F.col("r") + F.col("b")))
    log_a = F.col("log_c") - F.col("r") * (F.col("t") - F.col("b")) - F.col("r")
    value = F.shiftleft((log_a * F.lit(float(1 << 32))).cast("long"), 16).bitwiseOR(F.xxhash64("h", "t").bitwiseAND(F.lit(0xFFFF)))
    return rows.select(*keep, "place", F.when(F.col("term").isNotNull(), value).alias("value"))


def fingerprints(df: DataFrame, keys: list[str], text: str, edited: str) -> DataFrame:
    """keys, the fingerprints of two texts as arrays of longs (p, q), and near, the share of places in which they agree; keys tell rows apart.

    If df is dealt by one of the keys, nothing is shuffled.
    """
    df = df.select(*keys, words(F.col(text)).alias("w0"), words(F.col(edited)).alias("w1"))
    df = df.select(*keys, F.size("w0").alias("n0"), F.size("w1").alias("n1"), F.posexplode(F.array("w0", "w1")).alias("which", "words"))
    df = df.select(*keys, "n0", "n1", "which", F.explode_outer("words").alias("word"))
    df = df.select(*keys, "n0", "n1", F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term"), F.col("word").isNotNull().cast("int").alias("one"), "which")
    df = df.groupBy(*keys, "n0", "n1", "term").agg(F.sum(F.col("one") * (1 - F.col("which"))).alias("x"), F.sum(F.col("one") * F.col("which")).alias("y"))
    one = lambda weight, first, second, total: F.struct(F.col(weight).alias("weight"), F.lit(first).alias("first"), F.lit(second).alias("second"), total.alias("total"))
    same, text_only, edited_only = one("x", True, True, F.least("n0", "n1")), one("x", True, False, F.col("n0")), one("y", False, True, F.col("n1"))
    parts = F.when(F.col("x") == F.col("y"), F.array(same)).when(F.col("y") == 0, F.array(text_only)).when(F.col("x") == 0, F.array(edited_only)).otherwise(F.array(text_only, edited_only))
    df = sampled(df.select(*keys, "term", F.inline(parts)), [*keys, "first", "second"])
    least = lambda side: F.min(F.when(F.col(side), F.col("value")))
    df = df.groupBy(*keys, "place").agg(least("first").alias("first"), least("second").alias("second"))
    code = lambda side: F.coalesce(F.col(side).bitwiseAND(F.lit(0xFFFF)), F.lit(0).cast("long"))
    df = df.select(*keys, "place", code("first").alias("first"), code("second").alias("second"))
    lanes = lambda side, j: F.bit_or(F.when(F.floor(F.col("place") / LANES) == j, F.expr(f"shiftleft({side}, 16 * ({LANES - 1} - place % {LANES}))")).otherwise(F.lit(0).cast("long")))
    packed = [lanes(side, j).alias(f"{side}{j}") for side in ("first", "second") for j in range(SAMPLES // LANES)]
    df = df.groupBy(*keys).agg(*packed, F.sum((F.col("first") != F.col("second")).cast("int")).alias("apart"))
    longs = lambda side: F.array(*[F.col(f"{side}{j}") for j in range(SAMPLES // LANES)])
    return df.select(*keys, longs("first").alias("p"), longs("second").alias("q"), (1 - F.col("apart") / SAMPLES).alias("near"))


def hexadecimal(packed: Column) -> Column:
    """Four digits for each place."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.get(packed, F.lit(j))), 16, "0") for j in range(SAMPLES // LANES)]))


def likeness(a: Column, b: Column) -> Column:
    """The share of places in which two packed fingerprints agree."""
    apart = [F.get(a, F.lit(j)).bitwiseXOR(F.get(b, F.lit(j))) for j in range(SAMPLES // LANES)]
    equal = [F.when(x.bitwiseAND(F.lit(0xFFFF << 16 * i if i < 3 else -1 << 48)) == 0, 1).otherwise(0) for x in apart for i in range(LANES)]
    return sum(equal[1:], equal[0]) / SAMPLES


def sort_key() -> Column:
    """Documents come in descending order of this: null ids last, equal ids by the hash of their text, equal rows in any order."""
    return F.struct(F.col("id").isNotNull().alias("known"), "id", "h", "r")


def block_bounds(rows: DataFrame, block: int = BLOCK) -> list[dict]:
    """The keys at which blocks begin, in order, from a sample of SAMPLED_KEYS keys for each block."""
    n = rows.count()
    blocks = min(MOST_BLOCKS, -(-n // block))
    if blocks < 2:
        return []
    share = min(1.0, blocks * SAMPLED_KEYS / n)
    draw = F.pmod(F.xxhash64(F.lit("bound"), "id", "h", "r"), F.lit(1 << 30)) < F.lit(round(share * (1 << 30)))
    keys = rows.where(draw).agg(F.sort_array(F.collect_list(sort_key()), asc=False).alias("k"))
    every = F.filter("k", lambda x, i: (i % SAMPLED_KEYS == 0) & (i > 0))
    return json.loads(keys.select(F.to_json(every, {"ignoreNullFields": "false"}).alias("k")).first().k)


def block_of(bounds: list[dict], kind: str) -> Column:
    """How many bounds a row has reached, by bisection."""
    if not bounds:
        return F.lit(0)
    table = F.from_json(F.lit(json.dumps(bounds)), f"array<struct<known:boolean,id:{kind},h:bigint,r:bigint>>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    reached = lambda i: sort_key() <= F.get(table, i - 1)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(bounds)) & reached(at + step), at + step).otherwise(at))


def in_blocks(df: DataFrame, id_col: str, text_col: str, block: int = BLOCK) -> DataFrame:
    """block, ghost, id, h, r and text of every row, and once more, as a ghost, of the first row of the next block (after the last: of the first)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("r"), text.alias("text"))
    rows = rows.withColumn("block", block_of(block_bounds(rows.drop("text"), block), rows.schema["id"].dataType.simpleString()))
    # at most MOST_BLOCKS rows from here to the join
    heads = rows.groupBy("block").agg(F.max(sort_key()).alias("k"))
    before = Window.orderBy("block")
    last = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("block", F.col("k.id").alias("head_id"), F.col("k.h").alias("head_h"), F.coalesce(F.lag("block").over(before), F.last("block").over(last)).alias("guest_of"))
    first = rows.join(F.broadcast(heads), "block").where(F.col("id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h")))
    ghosts = first.groupBy("guest_of").agg(F.max(F.struct("id", "text")).alias("x"))
    rows = rows.select("block", F.lit(False).alias("ghost"), "id", "h", "r", "text")
    return rows.unionByName(ghosts.select(F.col("guest_of").alias("block"), F.lit(True).alias("ghost"), "x.id", F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("r"), "x.text"))


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and their likeness."""
    order = Window.partitionBy("block").orderBy("ghost", F.desc_nulls_last("id"), F.desc("h"), F.desc("r"))
    rows = in_blocks(df, id_col, text_col, block)
    rows = rows.select("block", "ghost", "id", "text", F.row_number().over(order).alias("at"), F.coalesce(F.lead("text").over(order), F.lit("")).alias("next_text"))
    rows = rows.withColumn("n_chars", F.length("text"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars") - cut), F.substring(F.col("next_text"), F.lit(1), cut)))
    prints = fingerprints(rows, ["block", "at"], "text", "edited")
    prints = prints.select("block", "at", "p", "q", "near", F.lead("p").over(Window.partitionBy("block").orderBy("at")).alias("next"))
    named = rows.where("not ghost").select("block", "at", "id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    return named.join(prints, ["block", "at"]).select(
        F.col("id").alias(id_col),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        hexadecimal(F.col("p")).alias("fingerprint"),
        hexadecimal(F.col("q")).alias("edited_fingerprint"),
        F.col("near").alias("near_edited"),
        likeness(F.col("p"), F.col("next")).alias("near_next"),
    )
