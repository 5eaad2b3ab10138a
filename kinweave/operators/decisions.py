"""From probabilities to matches: one owner for each candidate, then the match list with the best expected F-beta."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SMALL = 1e-6
BETA = 0.5


def resolve_constraints(predictions: DataFrame, prob: str = "cal_prob") -> DataFrame:
    """One row for each candidate: the S1 with the largest probability, of equals the smallest id; missing probabilities come last."""
    p = F.when(~F.isnan(prob), F.col(prob))
    order = Window.partitionBy("candidate_entity_id").orderBy(p.desc_nulls_last(), F.asc("source1_entity_id"))
    return predictions.withColumn("at_", F.row_number().over(order)).where("at_ = 1").drop("at_")


def constraint_report(predictions: DataFrame) -> DataFrame:
    """n_pairs, n_candidates and n_contested (candidates that several S1 claim)."""
    each = predictions.groupBy("candidate_entity_id").agg(F.count("*").alias("n"), (F.min("source1_entity_id") != F.max("source1_entity_id")).cast("long").alias("c"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"), F.count("*").alias("n_candidates"), F.coalesce(F.sum("c"), F.lit(0)).alias("n_contested"))


def expected_f_scan(resolved: DataFrame, prob: str = "cal_prob", beta: float = BETA) -> DataFrame:
    """For each S1 and each k from 1: the k-th candidate, the sum of the k largest probabilities and the expected F-beta.

    With precision S/k and recall S/T the score is (1 + b2) S / (b2 T + k). One window by S1, for both sums.
    """
    p = F.coalesce(F.when(~F.isnan(prob), F.col(prob)), F.lit(0.0))
    of = Window.partitionBy("source1_entity_id")
    order = of.orderBy(F.desc("p_"), "candidate_entity_id")
    rows = resolved.withColumn("p_", p).select(
        "source1_entity_id",
        "candidate_entity_id",
        F.col("p_").alias("prob"),
        F.row_number().over(order).cast("long").alias("k"),
        F.sum("p_").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("top_sum"),
        F.sum("p_").over(of).alias("total"),
    )
    b2 = beta * beta
    closed = (1 + b2) * F.col("top_sum") / (b2 * F.greatest("total", F.lit(SMALL)) + F.col("k"))
    return rows.withColumn("score", F.when(F.col("top_sum") < SMALL, 0.0).otherwise(closed))


def optimise_matches(resolved: DataFrame, s1_ids: DataFrame, prob: str = "cal_prob", beta: float = BETA, k0: str = "sum") -> DataFrame:
    """source1_entity_id, matched_ids, best_k and best_ef05 for every S1.

    Nothing is matched (score 1) where no candidate or no probability is left; otherwise the smallest k with the best
    score. k0 ``bernoulli`` scores an empty list by the probability that no candidate matches; off by default.
    """
    scan = expected_f_scan(resolved, prob, beta)
    best = F.max_by("k", F.struct(F.round("score", 12), -F.col("k")))
    picked = scan.groupBy("source1_entity_id").agg(
        best.alias("k"),
        F.max("score").alias("top"),
        F.max("total").alias("total"),
        F.exp(F.sum(F.log(F.greatest(1 - F.col("prob"), F.lit(1e-300))))).alias("none"),
        F.array_sort(F.collect_list(F.struct("k", "candidate_entity_id"))).alias("ranked"),
    )
    empty = (F.col("total") < SMALL) | (F.col("top") <= 0)
    if k0 == "bernoulli":
        empty = empty | (F.col("none") >= F.col("top"))
    chosen = picked.select(
        "source1_entity_id",
        F.when(empty, F.lit(0)).otherwise(F.col("k")).cast("long").alias("best_k"),
        F.when(F.col("total") < SMALL, 1.0).when(empty, F.col("none") if k0 == "bernoulli" else F.lit(0.0)).otherwise(F.col("top")).alias("best_ef05"),
        F.transform("ranked", lambda x: x["candidate_entity_id"]).alias("ids"),
    )
    ids = s1_ids.select(F.col("entity_id").alias("source1_entity_id"))
    out = ids.join(chosen, "source1_entity_id", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "source1_entity_id",
        F.when(F.coalesce("best_k", F.lit(0)) > 0, F.slice("ids", F.lit(1), F.col("best_k").cast("int"))).otherwise(none).alias("matched_ids"),
        F.coalesce("best_k", F.lit(0)).cast("long").alias("best_k"),
        F.coalesce("best_ef05", F.lit(1.0)).alias("best_ef05"),
    )


def k_distribution(matches: DataFrame) -> DataFrame:
    """How many S1 have each list length, and their mean expected score."""
    return matches.groupBy("best_k").agg(F.count("*").alias("n_s1"), F.avg("best_ef05").alias("mean_ef05"))
