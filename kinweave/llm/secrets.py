"""Secret scans with corpus-wide ownership frequency.

Patterns propose candidates in whole texts. The hash of each candidate's value is counted over
distinct owners and distinct repositories of the whole corpus: a value that many owners and repositories
hold is a copied example, one that few hold is live-looking. Rule-based candidates (assign,
access, hex) are always reported; generic long tokens only where they are live-looking and overlap no
rule-based one.

Defined results: null texts are empty and have no spans; repeated rows give repeated rows and count
once for each repository; rows without an owner or repository count as one nameless owner; extra columns
are not read. A hot value costs a partial sum for each task, and the join back is dealt by value
with both sides exchanged, so that adaptive execution can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm import spans as S
from kinweave.llm.common import semi_by_id, spare, stored, text_key

#: The rules' patterns, each as two groups that together are the match.
KINDS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""",
    "access": r"(AKIA)([A-Z0-9]{16,})",
    "hex": r"()((?<![0-9a-f])[0-9a-f]{24,})",
    "generic": r"()((?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,})",
}
NAMES = list(KINDS)
MIN_VALUE = 6
#: A value is an example from so many distinct owners and repositories on.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 5, 5


def ownership(candidates: DataFrame) -> DataFrame:
    """value_hash, n_owners, n_repositories of candidates (value_hash, owner, repository), each level summed before its shuffle."""
    each = candidates.select("value_hash", F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repository", F.lit("")).alias("repository")).distinct()
    by_owner = each.groupBy("value_hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id") -> DataFrame:
    """id and array<struct<start, kind, end, verdict>> ``found`` for every row, in order of start, then kind.

    verdict is ``live`` or ``example``.
    """
    rows = stored(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            F.col(owner_col).cast("string").alias("owner"),
            F.col(repository_col).cast("string").alias("repository"),
            S.parts(F.col(text_col).cast("string"), KINDS).alias("parts"),
        )
    )
    generic = NAMES.index("generic")
    looks_random = F.col("tail").rlike("[0-9]") & F.col("tail").rlike("[A-Z]") & F.col("tail").rlike("[a-z]")
    valid = F.when(F.col("kind") == 0, F.length("tail") >= MIN_VALUE).when(F.col("kind") == generic, looks_random).otherwise(True)
    value = F.when(F.col("kind") == 0, F.col("tail")).otherwise(F.concat("head", "tail"))
    found = S.matches(rows.where("size(parts) > 0"), ["owner", "repository"]).where(valid).select("row", "owner", "repository", "kind", "start", "end", F.sha2(value.cast("binary"), 256).alias("value_hash"))
    found = stored(found)
    counts = stored(ownership(found))
    example = (F.col("n_owners") >= EXAMPLE_OWNERS) & (F.col("n_repositories") >= EXAMPLE_REPOSITORIES)
    judged = found.join(counts, "value_hash").select("row", "start", "kind", "end", F.when(example, "example").otherwise("live").alias("verdict"))
    judged = stored(judged.where((F.col("kind") != generic) | (F.col("verdict") == "live")))
    lost = S.beaten(judged, F.col("kind") == generic, lambda b, s: b["kind"] != generic)
    kept = judged.join(lost, ["row", "kind", "start"], "left_anti").select("row", F.struct("start", "kind", "end", "verdict").alias("s"))
    lists = kept.groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("found"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,verdict:string>>")
    return rows.select("row", "id").join(lists, "row", "left").select(F.col("id").alias(id_col), F.coalesce("found", none).alias("found"))


def report(df: DataFrame, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """Counts, digests and spans for every row of df."""
    out = scan(df, id_col, **columns)
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == NAMES.index(k))).cast("long")
    base = F.filter("found", lambda s: s["kind"] != NAMES.index("generic"))
    judged = lambda v: F.size(F.filter("found", lambda s: s["verdict"] == v)).cast("long")
    return out.select(
        id_col,
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        S.sha256(S.joined(base, NAMES)).alias("base_sha256"),
        S.joined(F.col("found"), NAMES).alias("spans"),
        judged("live").alias("n_live"),
        judged("example").alias("n_example"),
    )


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "[SECRET]", **columns: str) -> DataFrame:
    """df with every live-looking span of its texts replaced by the label; all rows and columns stay."""
    key, live = spare(df, "key", "live")
    keyed = df.withColumn(key, text_key(id_col, text_col))
    spans = F.filter("found", lambda s: s["verdict"] == "live")
    hits = scan(keyed, key, text_col, **{"repository_col": id_col} | columns).select(key, spans.alias(live)).where(F.size(live) > 0).dropDuplicates([key])
    hits = stored(hits)
    out = semi_by_id(keyed, hits, hits.count(), key, "left")
    text = F.when(F.col(live).isNotNull(), S.replace_spans(F.col(text_col), F.col(live), label)).otherwise(F.col(text_col))
    return out.withColumn(text_col, text).drop(key, live)
