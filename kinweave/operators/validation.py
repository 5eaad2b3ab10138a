"""Checks of the two output tables, each a table of what is wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.text import badly_formatted, id_list
from kinweave.sources.tables import TRUTH_COLUMNS

CANDIDATE_COLUMNS = ("source1_entity_id", "candidate_entity_ids")


class InvalidOutput(ValueError):
    """An output table breaks a rule."""


def missing_columns(df: DataFrame, columns: tuple[str, ...]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def exploded(df: DataFrame, column: str) -> DataFrame:
    return df.select("source1_entity_id", F.explode(id_list(F.col(column))).alias("candidate_entity_id"))


def coverage(df: DataFrame, s1_ids: DataFrame) -> DataFrame:
    """source1_entity_id and problem (missing, extra or duplicate) of a table that must have each S1 once."""
    ids = s1_ids.select(F.trim("entity_id").alias("source1_entity_id")).distinct()
    have = df.groupBy("source1_entity_id").agg(F.count("*").alias("n"))
    both = ids.withColumn("known", F.lit(1)).join(have, "source1_entity_id", "full_outer")
    problem = F.when(F.col("n").isNull(), "missing").when(F.col("known").isNull(), "extra").when(F.col("n") > 1, "duplicate")
    return both.select("source1_entity_id", problem.alias("problem")).where("problem is not null")


def outside_candidates(matches: DataFrame, candidates: DataFrame, lenient: bool = False) -> DataFrame:
    """Matched ids that are no candidates of their S1; lenient skips S1 whose candidate list is empty."""
    allowed = exploded(candidates, "candidate_entity_ids").distinct()
    out = exploded(matches, "matched_ids").distinct().join(allowed, ["source1_entity_id", "candidate_entity_id"], "left_anti")
    return out.join(allowed.select("source1_entity_id").distinct(), "source1_entity_id", "left_semi") if lenient else out


def repeated_ids(df: DataFrame, column: str) -> DataFrame:
    """Rows whose list has an id more than once."""
    ids = id_list(F.col(column))
    return df.select("source1_entity_id", (F.size(ids) - F.size(F.array_distinct(ids))).cast("long").alias("n_repeated")).where("n_repeated > 0")


def shared_ids(matches: DataFrame) -> DataFrame:
    """Matched ids with several owners, and how many claims are too many."""
    claims = exploded(matches, "matched_ids").distinct().groupBy("candidate_entity_id").agg(F.count("*").alias("n_owners"))
    return claims.where("n_owners > 1").withColumn("n_violations", F.col("n_owners") - 1)


def bad_format(df: DataFrame, column: str) -> DataFrame:
    return df.where(badly_formatted(F.col(column))).select("source1_entity_id")


def validate(candidates: DataFrame, matches: DataFrame, s1_ids: DataFrame, lenient: bool = False, raise_on_error: bool = False, n_examples: int = 5) -> DataFrame:
    """check, violations and examples of all checks; raise_on_error raises at the first one that fails."""
    spark = matches.sparkSession
    schema = [("candidate_schema", missing_columns(candidates, CANDIDATE_COLUMNS)), ("match_schema", missing_columns(matches, TRUTH_COLUMNS))]
    if any(m for _, m in schema):
        if raise_on_error:
            raise InvalidOutput(f"missing columns: {schema}")
        return spark.createDataFrame([(n, len(m), ",".join(m)) for n, m in schema], "check string, violations long, examples string")
    sized = candidates.agg(F.count("*").alias("a")).crossJoin(matches.agg(F.count("*").alias("b"))).where("a != b").select(F.concat_ws(" ", "a", "b").alias("example"))
    named = {
        "candidate_coverage": coverage(candidates, s1_ids).select(F.concat_ws(":", "problem", "source1_entity_id").alias("example")),
        "match_coverage": coverage(matches, s1_ids).select(F.concat_ws(":", "problem", "source1_entity_id").alias("example")),
        "row_counts": sized,
        "subset": outside_candidates(matches, candidates, lenient).select(F.concat_ws(":", "source1_entity_id", "candidate_entity_id").alias("example")),
        "repeated_candidates": repeated_ids(candidates, "candidate_entity_ids").select(F.col("source1_entity_id").alias("example")),
        "repeated_matches": repeated_ids(matches, "matched_ids").select(F.col("source1_entity_id").alias("example")),
        "single_owner": shared_ids(matches).select(F.col("candidate_entity_id").alias("example")),
        "candidate_format": bad_format(candidates, "candidate_entity_ids").select(F.col("source1_entity_id").alias("example")),
        "match_format": bad_format(matches, "matched_ids").select(F.col("source1_entity_id").alias("example")),
    }
    found = None
    for name, df in named.items():
        part = df.withColumn("check", F.lit(name))
        found = part if found is None else found.unionByName(part)
    first = Window.partitionBy("check").orderBy("example")
    some = found.withColumn("at_", F.row_number().over(first)).groupBy("check").agg(F.count("*").alias("violations"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("at_") <= n_examples, F.col("example")))), ",").alias("examples"))
    names = spark.createDataFrame([(n,) for n in ("candidate_schema", "match_schema", *named)], "check string")
    out = names.join(some, "check", "left").na.fill(0, ["violations"]).na.fill("", ["examples"])
    if raise_on_error and (bad := out.where("violations > 0").first()):
        raise InvalidOutput(f"{bad['check']}: {bad['violations']} violations, such as {bad['examples']}")
    return out
