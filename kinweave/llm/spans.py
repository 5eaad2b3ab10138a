"""Positions of regular-expression matches in whole texts, by built-in functions only.

Spark's functions return matched text but no positions. Here each match is put between marks, the
marked text is split, and running sums of the parts' lengths give the positions, in code points. The
sums run over parts of the documents that have a match, not over texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Private-use characters; in a text they are replaced by a character that no pattern matches.
MARK, INNER, STAND_IN = "", "", "�"


#: Characters of context that are kept on either side of a match.
BEFORE, AFTER = 24, 8
CELL = 64


def part_of(number: int):
    def part(p: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(F.lit(number).alias("kind"), i.cast("int").alias("i"), (F.length(p) - odd.cast("int")).alias("size"), F.when(odd, p).otherwise(F.concat(F.substring(p, 1, AFTER), F.lit(INNER), F.right(p, F.lit(BEFORE)))).alias("value"))

    return part


def parts(text: Column, kinds: dict[str, str], hints: dict[str, str] | None = None) -> Column:
    """array<struct<kind, i, size, value>>: the parts of the text for each kind that occurs; those with odd i are matches, of the others value has the first and last characters.

    Each pattern has two capturing groups that together are the match; in value they are divided by INNER. A kind's hint is a
    simpler pattern that every text with a match has; a text without it is not searched.
    """
    text = F.coalesce(text, F.lit(""))
    text = F.when(text.contains(MARK) | text.contains(INNER), F.translate(text, MARK + INNER, STAND_IN * 2)).otherwise(text)
    none = F.array().cast("array<struct<kind:int,i:int,size:int,value:string>>")
    found = []
    for number, (name, pattern) in enumerate(kinds.items()):
        marked = F.regexp_replace(text, pattern, f"{MARK}$1{INNER}$2{MARK}")
        if hint := (hints or {}).get(name):
            marked = F.when(text.rlike(hint), marked).otherwise("")
        found.append(F.when(marked.contains(MARK), F.transform(F.split(marked, MARK, -1), part_of(number))).otherwise(none))
    return F.concat(*found)


def matches(rows: DataFrame, keep: list[str], column: str = "parts") -> DataFrame:
    """keep, kind (number), start, end, head and tail (the two groups), before and after (context) of every match; rows have a unique ``row``."""
    at = Window.partitionBy("row", "kind").orderBy("i")
    return (
        rows.select("row", *keep, F.inline(column))
        .withColumn("end", F.sum("size").over(at))
        .withColumn("before", F.split(F.lag("value").over(at), INNER, 2)[1])
        .withColumn("after", F.split(F.lead("value").over(at), INNER, 2)[0])
        .where("i % 2 = 1")
        .withColumn("start", F.col("end") - F.col("size"))
        .withColumn("both", F.split("value", INNER, 2))
        .select("row", *keep, "kind", "start", "end", F.col("both")[0].alias("head"), F.col("both")[1].alias("tail"), "before", "after")
    )


def beaten(spans: DataFrame, weak: Column, beats: Callable[[Column, Column], Column]) -> DataFrame:
    """row, kind and start of the weak spans that overlap another span of their row which beats them.

    Spans meet in the cells of CELL characters that they touch, so that a text with very many spans costs about their number.
    """
    fields = F.struct(*[c for c in spans.columns if c != "row"])
    cells = spans.withColumn("weak_", weak).withColumn("span_", fields).withColumn("cell_", F.explode(F.sequence(F.floor(F.col("start") / CELL), F.floor((F.col("end") - 1) / CELL))))
    a, b = cells.where("weak_").select("row", "cell_", F.col("span_").alias("a")), cells.select("row", "cell_", F.col("span_").alias("b"))
    meet = (F.col("a.start") < F.col("b.end")) & (F.col("b.start") < F.col("a.end"))
    return a.join(b, ["row", "cell_"]).where(meet & beats(F.col("b"), F.col("a"))).select("row", "a.kind", "a.start").distinct()


def joined(spans: Column, names: list[str]) -> Column:
    """kind:start:end of an array of structs, comma-joined in the array's order."""
    name = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def replace_spans(text: Column, spans: Column, label: str) -> Column:
    """The text with each span (structs with start and end, code points) replaced by the label; overlapping spans are merged."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].cast("long").alias("start"), s["end"].cast("long").alias("end"))))

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] >= acc["at"], F.concat(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(label))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

    done = F.aggregate(ordered, start, step)
    return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))
