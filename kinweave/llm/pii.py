"""Personal data by candidate gradient boosting.

High-recall generators propose overlapping spans in whole texts. Boosted trees score each proposal by
its format and its context; a threshold for each kind, calibrated on training rows that the trees
have not seen, selects what is redacted. Rule-based spans (email, ip, card, phone) always stay; the
trees add local phone numbers, spelt-out addresses, social security, bank account, account and passport numbers,
names after a title, dates of birth and street addresses.

The trees learn from a fixed recipe of TRAINING_ROWS labelled examples, made here; nothing of a corpus
is in them, so that a model is the same for every corpus and is fitted once in a session.

Defined results: null texts are empty and have no spans; repeated rows give repeated rows; equal or
overlapping proposals of the trees give the best-scored one, and none that meets a rule-based span; runs of any length are matched
without recursion; extra columns are not read.
"""

from __future__ import annotations

import json
import random

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import spans as S
from kinweave.llm.common import semi_by_id, spare, stored, text_key

#: The rules' patterns (the first four) and the other generators'. Matches begin where a run begins. Repeated groups are
#: possessive, which the regular-expression engine matches in a loop; greedy ones recurse and end long runs in a stack overflow.
KINDS = {
    "email": r"()((?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)",
    "ip": r"()((?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++)",
    "card": r"()((?=[0-9])(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9]){12,}+)",
    "phone": r"()(\+[0-9][\x20().0-9-]+[0-9])",
    "local_phone": r"()((?=[(0-9])(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-]))",
    "spelt_email": r"()((?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{2,63}(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{2,63}){1,8}+)",
    "ssn": r"()((?=[0-9])(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))",
    "iban": r"()((?=[A-Z])(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))",
    "account": r"()((?=[0-9])(?<![A-Za-z0-9.+/_-])[0-9](?:[\x20-]?[0-9]){8,33}+(?![A-Za-z0-9/_-]))",
    "passport": r"()((?=[A-Z])(?<![A-Za-z0-9-])[A-Z]{1,2}[0-9]{6,9}(?![A-Za-z0-9-]))",
    "birth_date": r"()((?=[0-9])(?<![0-9./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9/-]))",
    "name": r"()((?=[DFHMPS])(?<![\p{L}\p{N}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Madame|Monsieur|Se\u00f1or|Se\u00f1ora|Sr|Sra)\.?\x20\p{Lu}[\p{L}'-]{1,30}(?:\x20\p{Lu}[\p{L}'-]{1,30}){0,2})",
    "address": r"()((?=[0-9])(?<![0-9.,#-])[0-9]{1,5}\x20(?:\p{Lu}[\p{L}'.-]{1,24}\x20){1,3}(?:Street|St|Road|Rd|Avenue|Ave|Lane|Drive|Boulevard|Blvd|Court|Square)(?![\p{L}]))",
}
#: What every text with a match of the kind has.
HINTS = {"email": "@", "phone": r"\+[0-9]", "spelt_email": r"[\[(]at[\])]"} | {k: "[0-9]" for k in ("ip", "card", "local_phone", "ssn", "iban", "account", "passport", "birth_date", "address")}
NAMES = list(KINDS)
RULES = NAMES[:4]
#: Words before a span that speak for personal data, by what they announce, and words that speak for a thing.
CONTEXT = {
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|contact|dial|ring)\b",
    "mail": r"(?i)\b(?:e-?mail|mail|write|contact|reach)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|pan)\b",
    "number": r"(?i)\b(?:ssn|social|security|tax)\b",
    "bank": r"(?i)\b(?:iban|account|acct|bank|customer|member|transfer|pay|deposit)\b",
    "papers": r"(?i)\b(?:passport|travel|document|identity|licen[cs]e|visa)\b",
    "birth": r"(?i)\b(?:born|birth|dob|birthday)\b",
    "place": r"(?i)\b(?:address|lives?|living|home|house|reside[sd]?|at|deliver(?:ed)?|ship|moved)\b",
    "thing": r"(?i)\b(?:version|order|part|isbn|ticket|invoice|serial|build|ref|page|id|model|flight|chapter|section|figure|lot|sku|released?|updated?|published|meeting|barcode|timestamp|character|episode|seat)\b",
}
ROLES = r"(?i)\b(?:president|chairman|chairwoman|speaker|minister|secretary|judge|right|wrong|nobody|everybody|who|strange|universe|olympia|doctor|ambassador)\b"
TRAINING_ROWS, TREES, DEPTH, SEED = 5_200, 20, 5, 17
#: Of the calibration rows that a kind's threshold accepts, this share is right.
PRECISION = 0.98


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    n = F.length(d)
    value = lambda i: F.substring(d, n - i, F.lit(1)).cast("int")  # noqa: E731  the i-th from the right
    term = lambda i: F.when(i % 2 == 0, value(i)).otherwise(F.when(value(i) > 4, value(i) * 2 - 9).otherwise(value(i) * 2))
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + term(i)) % 10 == 0).otherwise(False)


def valid(kind: Column, v: Column) -> Column:
    """Whether a proposal satisfies its rule; false for kinds without one."""
    d = digits(v)
    part = F.forall(F.split(v, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    return (
        F.when(kind == 0, True)
        .when(kind == 1, part)
        .when(kind == 2, F.length(d).between(13, 19) & luhn(F.when(F.length(d) <= 19, d).otherwise("")))
        .when(kind == 3, F.length(d).between(9, 15))
        .otherwise(False)
    )


def features(df: DataFrame) -> DataFrame:
    """df (kind, value, before, after) with a vector of format and context features."""
    v, d = F.col("value"), digits(F.col("value"))
    before, after = F.coalesce("before", F.lit("")), F.coalesce("after", F.lit(""))
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    columns = {f"is_{n}": number(F.col("kind") == i) for i, n in enumerate(NAMES)}
    columns |= {f"says_{n}": number(before.rlike(p)) for n, p in CONTEXT.items()}
    columns |= {
        "length": number(F.length(v)),
        "digits": number(F.length(d)),
        "letters": number(F.length(F.regexp_replace(v, r"[^\p{L}]", ""))),
        "marks": number(F.length(F.regexp_replace(v, r"[\p{L}0-9\x20]", ""))),
        "kinds_of_digits": number(F.size(F.array_distinct(F.split(F.substring(d, 1, 40), "")))),
        "rule": number(valid(F.col("kind"), v)),
        "luhn": number(luhn(F.substring(d, 1, 19))),
        "zero_group": number(v.rlike("^(?:000|666|9)|-00-|-0000$")),
        "date_like": number(d.rlike("^(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])(?:[0-2][0-9]|3[01])")),
        "role": number(v.rlike(ROLES)),
        "glued": number(before.rlike("[A-Za-z0-9_/#=-]$")),
        "glued_after": number(after.rlike("^[A-Za-z0-9_/=-]")),
    }
    named = {f"f_{k}": c for k, c in columns.items()}
    out = df.withColumns(named)
    return VectorAssembler(inputCols=list(named), outputCol="features").transform(out).drop(*named)


def examples(n: int = TRAINING_ROWS, seed: int = SEED) -> list[dict]:
    """Labelled proposals by a fixed recipe: real forms with fitting context, look-alikes with other context or broken form."""
    r = random.Random(seed)
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(r.randint(3, 8)))
    caps = lambda: word().title()
    good = {
        "phone": ["phone ", "call me: ", "tel. ", "mobile ", "call ", "fax: ", "telephone: ", "ring us at "],
        "mail": ["e-mail ", "write to ", "contact: ", "mail me at "],
        "card": ["card no. ", "visa "],
        "number": ["ssn ", "social security number ", "SSN: ", "tax number "],
        "bank": ["iban ", "account ", "account number: ", "bank transfer to ", "acct. ", "customer ", "pay into ", "my account is "],
        "papers": ["passport ", "passport no. ", "travel document ", "identity card ", "passport number: "],
        "birth": ["born ", "born on ", "date of birth: ", "DOB ", "birthday: ", "birth date "],
        "place": ["address: ", "lives at ", "home: ", "deliver to ", "moved to ", "house at "],
        "title": [f"{word()} ", "", "by ", "with ", "for ", "asked "],
    }
    bad = ["order ", "version ", "part ", "invoice ", "serial ", "ticket ref ", "page id ", "model ", "flight ", "chapter ", "lot ", "barcode ", "build "]
    day = lambda first, last: r.choice([f"{r.randint(1, 28)}{(m := r.choice('./-'))}{r.randint(1, 12)}{m}{r.randint(first, last)}", f"{r.randint(first, last)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}"])
    title = lambda: r.choice(["Mr", "Mr.", "Mrs.", "Ms.", "Dr.", "Dr", "Prof.", "Herr", "Frau", "Mme", "Sra."])
    broken = lambda: r.choice([f"20{num(2)}0{r.randint(1, 9)}1{num(1)}{num(r.choice([4, 6]))}", r.choice("0123456789") * r.randint(9, 14), num(r.randint(9, 16))])
    topics = {"email": "mail", "spelt_email": "mail", "phone": "phone", "local_phone": "phone", "card": "card", "iban": "bank", "account": "bank", "passport": "papers", "birth_date": "birth", "name": "title", "address": "place"}
    #: How often a real one is announced, and how often a look-alike stands after a word for a thing.
    told_share = {"account": 0.5, "passport": 1.0, "birth_date": 1.0, "address": 0.6, "iban": 0.7, "spelt_email": 0.6}
    rows = []
    for i in range(n):
        kind = i % len(NAMES)
        name, yes = NAMES[kind], r.random() < 0.5
        sep = r.choice(" .-")
        value = {
            "email": lambda: f"{word()}.{num(2)}@{word()}.{r.choice(['com', 'org', 'net'])}",
            "ip": lambda: ".".join(str(r.randint(1, 255 if yes else 999)) for _ in range(4)),
            "card": lambda: num(16),
            "phone": lambda: f"+{r.randint(1, 49)} {num(3)} {num(3)} {num(4)}" if yes else f"+{num(1)} {num(r.choice([2, 3, 18]))}",
            "local_phone": lambda: f"{r.randint(2, 9)}{num(2)}{sep}{r.randint(2, 9)}{num(2)}{sep}{num(4)}" if yes or r.random() < 0.5 else f"000{sep}{num(3)}{sep}{num(4)}",
            "spelt_email": lambda: f"{word()}{r.choice([' (at) ', '[at]', ' [at] '])}{word()}{r.choice([' (dot) ', '.', '[dot]'])}{r.choice(['com', 'org', 'net', 'de'])}" if yes else f"{num(2)} (at) {num(2)}.{num(2)}",
            "ssn": lambda: f"{r.randint(1, 8)}{num(2)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}" if yes or r.random() < 0.5 else f"000-{num(2)}-{num(4)}",
            "iban": lambda: f"{r.choice(['DE', 'FR', 'ES', 'GB', 'NL', 'IT'])}{num(2)} " + " ".join(num(4) for _ in range(r.randint(3, 5))) if yes else f"{r.choice('XZQ')}{r.choice('XZQ')}{num(2)}" + "".join(r.choice("ABCDEFGH") for _ in range(12)),
            "account": lambda: r.choice([f"{r.randint(1, 9)}{num(r.randint(10, 17))}", " ".join(num(4) for _ in range(4)), f"{num(8)}-{num(3)}"]) if yes else broken(),
            "passport": lambda: r.choice("ABCEKLPX") + r.choice(["", r.choice("ABCDEF")]) + num(r.randint(7, 8)),
            "birth_date": lambda: day(1930, 2012) if yes else day(1990, 2035),
            "name": lambda: f"{title()} {caps()}" + r.choice(["", f" {caps()}"]) if yes else f"{title()} {r.choice(['President', 'Speaker', 'Chairman', 'Minister', 'Secretary', 'Right', 'Who', 'Nobody', 'Universe', 'Ambassador'])}",
            "address": lambda: f"{r.randint(1, 999)} {caps()} {r.choice([caps() + ' ', ''])}{r.choice(['Street', 'Road', 'Avenue', 'Lane', 'St', 'Square'])}",
        }[name]()
        told = r.random() < told_share.get(name, 0.9 if kind >= 4 else 0.5)
        context = r.choice(good[topics.get(name, "number")]) if told else f"{word()} "
        # a bare look-alike of what only its announcement tells apart is no personal data
        before = context if yes else r.choice(bad) if name in ("account", "address") or r.random() < 0.6 else f"{word()} "
        if name == "account" and not yes and r.random() < 0.3:
            value, before = r.choice([value[:8], f"20{num(2)}0{r.randint(1, 9)}1{num(1)}{num(6)}", r.choice("0123456789") * 12]), f"{word()} "
        if name == "card":
            k = [int(c) for c in value[:-1]]
            total = sum(c if j % 2 else (c * 2 - 9 if c > 4 else c * 2) for j, c in enumerate(reversed(k)))
            value = value[:-1] + str((10 - total % 10 + (0 if yes else r.randint(1, 9))) % 10)
        glue = not yes and r.random() < 0.3
        rows.append({"id": i, "kind": kind, "value": value, "before": before + ("x-" if glue else ""), "after": "-" + num(2) if glue and r.random() < 0.5 else r.choice([" ", ".", ", "]) + word(), "label": float(yes)})
    return rows


_trained: dict[str, tuple[GBTClassificationModel, dict[int, float]]] = {}


def train(spark: SparkSession) -> tuple[GBTClassificationModel, dict[int, float]]:
    """The trees, and for each kind the least score, 0.5 or more, from which on PRECISION of the calibration third's examples are right."""
    session = spark.sparkContext.applicationId
    if session not in _trained:
        rows = F.from_json(F.lit(json.dumps(examples())), "array<struct<id:int,kind:int,value:string,before:string,after:string,label:double>>")
        table = features(spark.range(1, numPartitions=1).select(F.inline(rows)))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=SEED, cacheNodeIds=False).fit(table.where("id % 3 != 0"))
        held: dict[int, list[tuple[float, float]]] = {}
        for x in score(model, table.where("id % 3 = 0")).select("kind", "score", "label").collect():  # a third of TRAINING_ROWS
            held.setdefault(x.kind, []).append((x.score, x.label))
        _trained.clear()
        _trained[session] = model, {k: threshold(v) for k, v in held.items()}
    return _trained[session]


def threshold(held: list[tuple[float, float]], precision: float = PRECISION) -> float:
    """The least of the scores, 0.5 or more, from which on that share of the labels is 1."""
    best, right = 1.0, 0.0
    ordered = sorted(held, reverse=True)
    for i, (x, label) in enumerate(ordered, 1):
        right += label
        if x >= 0.5 and right >= precision * i and (i == len(ordered) or ordered[i][0] < x):
            best = x
    return best


def score(model: GBTClassificationModel, table: DataFrame) -> DataFrame:
    return model.transform(table).withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and array<struct<kind, start, end, rule, score>> ``found`` for every row, in order of kind, then start."""
    spark = df.sparkSession
    rows = stored(df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), S.parts(F.col(text_col).cast("string"), KINDS, HINTS).alias("parts")))
    proposals = S.matches(rows.where("size(parts) > 0"), []).withColumn("value", F.col("tail"))
    model, least = train(spark)
    scored = score(model, features(proposals)).withColumn("rule", valid(F.col("kind"), F.col("value")))
    limit = F.create_map(*[x for k in range(len(NAMES)) for x in (F.lit(k), F.lit(least.get(k, 0.5)))])
    chosen = scored.where(F.col("rule") | ((F.col("kind") >= len(RULES)) & (F.col("score") >= limit[F.col("kind")])))
    chosen = stored(chosen.select("row", "kind", "start", "end", "rule", F.round("score", 6).alias("score")))
    better = lambda b, s: b["rule"] | (b["score"] > s["score"]) | ((b["score"] == s["score"]) & ((b["start"] < s["start"]) | ((b["start"] == s["start"]) & (b["kind"] < s["kind"]))))
    lost = S.beaten(chosen, ~F.col("rule"), better)
    kept = chosen.join(lost, ["row", "kind", "start"], "left_anti")
    lists = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end", "rule", "score"))).alias("found"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,rule:boolean,score:double>>")
    return rows.select("row", "id").join(lists, "row", "left").select(F.col("id").alias(id_col), F.coalesce("found", none).alias("found"))


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, digests and spans for every row of df."""
    out = scan(df, id_col, text_col)
    count = lambda k: F.size(F.filter("found", lambda s: s["rule"] & (s["kind"] == NAMES.index(k)))).cast("long")
    return out.select(
        id_col,
        *[count(k).alias(f"n_{k}") for k in RULES],
        S.sha256(S.joined(F.filter("found", lambda s: s["rule"]), NAMES)).alias("base_sha256"),
        S.joined(F.col("found"), NAMES).alias("spans"),
        F.size(F.filter("found", lambda s: ~s["rule"])).cast("long").alias("n_added"),
    )


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "[PII]") -> DataFrame:
    """df with every found span of its texts replaced by the label; all rows and columns stay."""
    key, spans = spare(df, "key", "spans")
    keyed = df.withColumn(key, text_key(id_col, text_col))
    hits = scan(keyed, key, text_col).where("size(found) > 0").dropDuplicates([key])
    hits = stored(hits.withColumnRenamed("found", spans))
    out = semi_by_id(keyed, hits, hits.count(), key, "left")
    text = F.when(F.col(spans).isNotNull(), S.replace_spans(F.col(text_col), F.col(spans), label)).otherwise(F.col(text_col))
    return out.withColumn(text_col, text).drop(key, spans)
