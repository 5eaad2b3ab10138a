"""Quality metrics as tables: F-beta of groups, thresholds, evaluation, precision, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BETA = 0.5
#: Ranges of scores that are ordered separately.
SCORE_BINS = 4096


def f_beta(tp: Column, fp: Column, fn: Column, beta: float, empty: Column) -> Column:
    """F-beta of counts; ``empty`` where precision and recall are both 0."""
    b2 = beta * beta
    return F.when(tp == 0, empty).otherwise((1 + b2) * tp / ((1 + b2) * tp + b2 * fn + fp))


def group_f(df: DataFrame, predicted: Column, label: str = "label", beta: float = BETA, by: tuple[str, ...] = ()) -> DataFrame:
    """f of every S1 that has rows. Without a true positive it is 1 where the S1 has no positive label at all, else 0."""
    hit, miss = (predicted & (F.col(label) == 1)), (predicted & (F.col(label) != 1))
    counts = df.groupBy(*by, "source1_entity_id").agg(F.sum(hit.cast("long")).alias("tp"), F.sum(miss.cast("long")).alias("fp"), F.sum((~predicted & (F.col(label) == 1)).cast("long")).alias("fn"))
    return counts.withColumn("f", f_beta(F.col("tp"), F.col("fp"), F.col("fn"), beta, F.when(F.col("tp") + F.col("fn") == 0, 1.0).otherwise(0.0)))


def macro_f(df: DataFrame, threshold: float, prob: str = "cal_prob", label: str = "label", beta: float = BETA) -> DataFrame:
    """macro_f, one row: the mean over the S1 that have candidate rows; 0 if there is none."""
    return group_f(df, F.col(prob) >= threshold, label, beta).agg(F.coalesce(F.avg("f"), F.lit(0.0)).alias("macro_f"))


def thresholds(n_steps: int) -> list[float]:
    return [0.01 + 0.98 * i / (n_steps - 1) for i in range(n_steps)] if n_steps > 1 else [0.01]


def threshold_scan(df: DataFrame, n_steps: int = 50, prob: str = "cal_prob", label: str = "label", beta: float = BETA) -> DataFrame:
    """step, threshold and macro_f for n_steps thresholds from 0.01 to 0.99.

    A pair counts for all thresholds up to its probability, so each pair is put into one bin and the
    bins of an S1 are summed from the top: rows are not multiplied by thresholds before they are grouped.
    """
    grid = F.array(*[F.lit(t) for t in thresholds(n_steps)])
    bin_ = F.size(F.filter(grid, lambda t: F.col(prob) >= t))
    binned = df.groupBy("source1_entity_id", bin_.alias("bin")).agg(F.count("*").alias("n"), F.sum((F.col(label) == 1).cast("long")).alias("pos"))
    per = binned.groupBy("source1_entity_id").agg(F.collect_list(F.struct("bin", "n", "pos")).alias("bins"), F.sum("pos").alias("all_pos"))
    steps = per.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n_steps))))
    total = lambda field: F.aggregate("bins", F.lit(0).cast("long"), lambda acc, b: acc + F.when(b["bin"] >= F.col("step"), b[field]).otherwise(0))
    counted = steps.select("step", total("pos").alias("tp"), total("n").alias("chosen"), "all_pos")
    scored = counted.withColumn("f", f_beta(F.col("tp"), F.col("chosen") - F.col("tp"), F.col("all_pos") - F.col("tp"), beta, F.when(F.col("all_pos") == 0, 1.0).otherwise(0.0)))
    return scored.groupBy("step").agg(F.avg("f").alias("macro_f")).select(F.col("step").cast("long").alias("step"), F.get(grid, F.col("step").cast("int") - 1).alias("threshold"), "macro_f")


def best_threshold(df: DataFrame, n_steps: int = 50, prob: str = "cal_prob", label: str = "label", beta: float = BETA) -> DataFrame:
    """threshold and macro_f, one row: the best of the scan, of equals the lowest; 0.5 and 0 if none is above 0."""
    scan = threshold_scan(df, n_steps, prob, label, beta)
    top = scan.agg(F.max_by(F.struct("threshold", "macro_f"), F.struct(F.round("macro_f", 12), -F.col("step"))).alias("t"))
    good = F.col("t.macro_f") > 0
    return top.select(F.when(good, F.col("t.threshold")).otherwise(0.5).alias("threshold"), F.when(good, F.col("t.macro_f")).otherwise(0.0).alias("macro_f"))


def evaluate(matches: DataFrame, truth: DataFrame, beta: float = BETA) -> DataFrame:
    """f of every row of matches (source1_entity_id, matched_ids array) against the truth's pairs.

    An S1 that is not in the truth has no true match; nothing matched and nothing true is 1, otherwise no true positive is 0.
    """
    predicted = matches.select("source1_entity_id", F.explode("matched_ids").alias("candidate_entity_id")).distinct().withColumn("p", F.lit(1))
    known = truth.select("source1_entity_id", "candidate_entity_id").distinct().withColumn("t", F.lit(1))
    pairs = predicted.join(known, ["source1_entity_id", "candidate_entity_id"], "full_outer")
    one = lambda c: F.coalesce(F.sum(c), F.lit(0))
    counts = pairs.groupBy("source1_entity_id").agg(one(F.when(F.col("p").isNotNull() & F.col("t").isNotNull(), 1)).alias("tp"), one(F.when(F.col("t").isNull(), 1)).alias("fp"), one(F.when(F.col("p").isNull(), 1)).alias("fn"))
    rows = matches.select("source1_entity_id").join(counts, "source1_entity_id", "left").na.fill(0, ["tp", "fp", "fn"])
    return rows.withColumn("f", f_beta(F.col("tp"), F.col("fp"), F.col("fn"), beta, F.when(F.col("tp") + F.col("fp") + F.col("fn") == 0, 1.0).otherwise(0.0)))


def evaluation_summary(matches: DataFrame, truth: DataFrame, beta: float = BETA) -> DataFrame:
    """n_s1, tp, fp, fn, micro precision and recall, and the macro F-beta over all S1."""
    each = evaluate(matches, truth, beta)
    out = each.agg(F.count("*").alias("n_s1"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")], F.coalesce(F.avg("f"), F.lit(0.0)).alias("macro_f"))
    share = lambda a, b: F.when(F.col(a) + F.col(b) == 0, 0.0).otherwise(F.col(a) / (F.col(a) + F.col(b)))
    return out.withColumn("precision", share("tp", "fp")).withColumn("recall", share("tp", "fn"))


def average_precision(df: DataFrame, score: str = "cal_prob", label: str = "label") -> DataFrame:
    """average_precision (step-wise) and roc_auc, one row; 0 where only one class is present.

    Counts are summed per distinct score, then per one of SCORE_BINS ranges of scores: the one pass over all sees the ranges' sums only,
    and each range is ordered by itself.
    """
    per = df.groupBy(F.round(score, 9).alias("s")).agg(F.count("*").alias("n"), F.sum((F.col(label) == 1).cast("long")).alias("pos"))
    per = per.withColumn("bin", F.floor(F.greatest(F.least("s", F.lit(1.0)), F.lit(0.0)) * SCORE_BINS).cast("int"))
    every = Window.orderBy(F.desc("bin"))
    above = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    bins = per.groupBy("bin").agg(F.sum("pos").alias("bin_pos"), F.sum("n").alias("bin_n"))
    bins = bins.select("bin", F.coalesce(F.sum("bin_pos").over(above), zero).alias("tp_above"), F.coalesce(F.sum("bin_n").over(above), zero).alias("n_above"), F.sum("bin_pos").over(whole).alias("p"), F.sum("bin_n").over(whole).alias("all"))
    down = Window.partitionBy("bin").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    run = per.join(F.broadcast(bins), "bin").select("pos", "n", (F.col("tp_above") + F.sum("pos").over(down)).alias("tp"), (F.col("n_above") + F.sum("n").over(down)).alias("at"), "p", "all")  # SCORE_BINS + 1 bins at most
    area = F.sum((F.col("n") - F.col("pos")) * (F.col("tp") - F.col("pos") / 2))
    out = run.agg(F.sum(F.col("pos") * F.col("tp") / F.col("at")).alias("ap"), area.alias("area"), F.max("p").alias("p"), F.max("all").alias("all"))
    ok = (F.col("p") > 0) & (F.col("p") < F.col("all"))
    return out.select(F.when(ok, F.col("ap") / F.col("p")).otherwise(0.0).alias("average_precision"), F.when(ok, F.col("area") / (F.col("p") * (F.col("all") - F.col("p")))).otherwise(0.0).alias("roc_auc"))


def quantiles(df: DataFrame, column: str, shares: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)) -> DataFrame:
    """share and value (linear interpolation, exact)."""
    values = df.agg(F.percentile(column, F.array(*[F.lit(s) for s in shares])).alias("v"))
    return values.select(F.inline(F.zip_with(F.array(*[F.lit(s) for s in shares]), "v", lambda s, x: F.struct(s.alias("share"), x.alias("value")))))


def submission_summary(candidate_lists: DataFrame, match_lists: DataFrame) -> DataFrame:
    """One row of counts, quantiles of list lengths and distinct matched ids of the two output tables."""
    size = lambda c: F.size(F.filter(F.split(F.coalesce(F.col(c), F.lit("")), ","), lambda x: F.trim(x) != ""))
    q = lambda s: F.percentile("n", F.lit(s))
    m = match_lists.select(size("matched_ids").alias("n")).agg(
        F.count("*").alias("n_s1"), F.sum((F.col("n") > 0).cast("long")).alias("n_matched_s1"), F.sum((F.col("n") == 0).cast("long")).alias("n_singletons"), F.sum("n").alias("n_matches"),
        *[q(s).alias(a) for s, a in ((0.0, "matches_min"), (0.25, "matches_p25"), (0.5, "matches_median"), (0.75, "matches_p75"), (0.9, "matches_p90"), (1.0, "matches_max"))],
    )
    c = candidate_lists.select(size("candidate_entity_ids").alias("n")).agg(F.avg("n").alias("candidates_mean"), q(0.5).alias("candidates_median"), F.max("n").cast("long").alias("candidates_max"), F.sum((F.col("n") == 0).cast("long")).alias("n_without_candidates"))
    u = match_lists.select(F.explode(F.split(F.coalesce("matched_ids", F.lit("")), ",")).alias("i")).select(F.trim("i").alias("i")).where("i != ''").agg(F.countDistinct("i").alias("n_unique_matched"))
    return m.crossJoin(F.broadcast(c)).crossJoin(F.broadcast(u))  # one row each
