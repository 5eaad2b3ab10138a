"""The entity-resolution pipeline: six stages that communicate by files, and their command line.

    python -m kinweave.plans.pipeline all --config config.json
    python -m kinweave.plans.pipeline STAGE [flags]

Stages: preprocess (--no-mine), block (--no-cache), features (--no-labels), model (--inference-only),
optimise (--beta, --skip-constraint), validate (--summary, --smoke-test).
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions.text import PIN_PATTERN, STREET_PATTERN
from kinweave.operators import decisions, metrics, preprocess, retrieval, validation
from kinweave.operators import features as pair
from kinweave.operators import model as matching
from kinweave.sources import tables


#: The settings of a file with sections, by their path, and the parameter that each one sets.
SECTIONS = {
    "paths.source1": "source1", "paths.source2": "source2", "paths.source3": "source3", "paths.ground_truth": "ground_truth",
    "paths.candidate_pairs": "candidate_pairs", "paths.matching_results": "matching_results", "paths.model_dir": "model_dir", "paths.cache_dir": "cache_dir",
    "preprocessing.min_token_freq": "min_token_freq", "preprocessing.top_k_substitutions": "top_k_substitutions",
    "blocking.top_n_per_entity": "top_n_per_entity", "blocking.tfidf.max_features": "max_features", "blocking.tfidf.top_k": "tfidf_top_k",
    "blocking.semantic.top_k": "semantic_top_k", "blocking.semantic.faiss_index_type": "index_type",
    "features.number_veto.pin_regex": "pin_regex", "features.number_veto.street_num_regex": "street_num_regex",
    "features.competition_features.enabled": "competition_features", "features.transitivity_features.enabled": "transitivity_features", "features.transitivity_features.max_pairs": "max_pairs",
    "model.cv_n_splits": "cv_n_splits", "model.xgboost.n_estimators": "max_iter", "model.xgboost.max_depth": "max_depth", "model.xgboost.learning_rate": "learning_rate",
    "postprocessing.constraint_resolution.enabled": "constraint_resolution", "postprocessing.f05_optimization.beta": "beta",
}
#: Settings of such files that this engine has with one value only; another value is an error, not ignored.
ONLY = {
    "preprocessing.lowercase": True, "preprocessing.strip_accents": True, "preprocessing.remove_punctuation": True, "preprocessing.expand_abbreviations": True,
    "blocking.tfidf.analyzer": "char_wb", "blocking.tfidf.ngram_range": [2, 4], "blocking.semantic.normalize_embeddings": True,
    "features.jaro_winkler_prefix_weight": 0.1, "features.number_veto.enabled": True, "model.cv_group_col": "source1_entity_id",
    "model.xgboost.subsample": 0.8, "model.xgboost.colsample_bytree": 0.8, "model.xgboost.min_child_weight": 5, "model.xgboost.scale_pos_weight": 10, "model.xgboost.random_state": 42,
    "model.calibration.method": "isotonic", "postprocessing.f05_optimization.enabled": True, "seed": 42,
}
#: Settings that have no effect on results here (folders that others repeat, sizes and names of another library's objects).
WITHOUT_EFFECT = {
    "paths.data_dir", "paths.output_dir", "blocking.semantic.model_name", "blocking.semantic.batch_size", "features.competition_features.similarity_col",
    "model.xgboost.objective", "model.xgboost.eval_metric", "model.xgboost.tree_method", "postprocessing.f05_optimization.prob_grid_steps", "n_jobs",
}


def flattened(values: dict) -> dict:
    """A file's settings by parameter: those of a file with sections are translated, others stay."""
    out: dict = {}

    def walk(node: dict, path: str) -> None:
        for key, value in node.items():
            name = f"{path}{key}"
            if name in SECTIONS:
                out[SECTIONS[name]] = value
            elif name in ONLY:
                if value != ONLY[name]:
                    raise ValueError(f"{name} can only be {ONLY[name]}")
            elif isinstance(value, dict):
                walk(value, f"{name}.")
            elif name not in WITHOUT_EFFECT:
                out[name] = value

    walk(values, "")
    return out


@dataclass(frozen=True)
class Config:
    """Paths and parameters; a JSON (or, where a reader is installed, YAML) file may set any of them."""

    source1: str = "data/source1.tsv"
    source2: str = "data/source2.tsv"
    source3: str = "data/source3.tsv"
    ground_truth: str = "data/ground_truth.tsv"
    cache_dir: str = "output/cache"
    model_dir: str = "output/models"
    candidate_pairs: str = "output/candidate_pairs"
    matching_results: str = "output/matching_results"
    dictionary: str = "output/cache/replacements"
    min_token_freq: int = 5
    top_k_substitutions: int = 200
    prefer: str = "last"
    top_n_per_entity: int = 50
    max_features: int = 200_000
    tfidf_top_k: int = 30
    semantic_top_k: int = 30
    index_type: str = "Flat"
    embedding_dimensions: int = 384
    pin_regex: str = PIN_PATTERN
    street_num_regex: str = STREET_PATTERN
    competition_features: bool = True
    transitivity_features: bool = True
    max_pairs: int = 500
    cv_n_splits: int = 5
    max_iter: int = matching.MAX_ITER
    max_depth: int = 6
    learning_rate: float = 0.05
    constraint_resolution: bool = True
    beta: float = 0.5
    k0: str = "sum"

    @classmethod
    def load(cls, path: str | None) -> Config:
        if not path:
            return cls()
        with open(path, encoding="utf-8") as f:
            if path.endswith((".yaml", ".yml")):
                import yaml

                values = yaml.safe_load(f)
            else:
                values = json.load(f)
        values = flattened(values or {})
        known = {f.name for f in fields(cls)}
        if unknown := set(values) - known:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        return cls(**values)


def stage_preprocess(spark: SparkSession, c: Config, mine: bool = True) -> None:
    """Reads the sources, mines replacements (or reads the saved ones) and writes the preprocessed tables."""
    sources = [tables.read_records(spark, p) for p in (c.source1, c.source2, c.source3)]
    if mine:
        plain = [preprocess.preprocess(s, None, c.pin_regex, c.street_num_regex) for s in sources]
        pairs = tables.truth_pairs(tables.read_truth(spark, c.ground_truth))
        mined = preprocess.mine_substitutions(plain[0], plain[1].unionByName(plain[2], allowMissingColumns=True), pairs, c.min_token_freq, c.top_k_substitutions, c.prefer)
        mined.coalesce(1).write.mode("overwrite").json(c.dictionary)
    saved = spark.read.schema("noisy string, canonical string").json(c.dictionary)
    table = {r.noisy: r.canonical for r in saved.collect()}  # top_k_substitutions rows at most
    for i, s in enumerate(sources, 1):
        tables.write_stage(preprocess.preprocess(s, table, c.pin_regex, c.street_num_regex), f"{c.cache_dir}/records_{i}.parquet")


def preprocessed(spark: SparkSession, c: Config) -> list[DataFrame]:
    return [tables.read_stage(spark, f"{c.cache_dir}/records_{i}.parquet", "preprocess") for i in (1, 2, 3)]


def embedded(spark: SparkSession, c: Config, name: str, records: DataFrame, cache: bool) -> DataFrame:
    """id and vector of every record; kept under a hash of the texts, so that a stale table is never read."""
    rows = records.select(F.col("entity_id").alias("id"), "search_text")
    key = rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64("id", "search_text").cast("decimal(38,0)")).alias("h")).first()
    path = f"{c.cache_dir}/vectors_{name}_{c.embedding_dimensions}_{key.n}_{str(key.h).replace('-', 'm')}.parquet"
    if cache:
        try:
            return spark.read.parquet(path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    encode = retrieval.hashed_encoder(c.embedding_dimensions)
    tables.write_stage(rows.select("id", encode(F.col("search_text")).alias("vector")), path)
    return spark.read.parquet(path)


def stage_block(spark: SparkSession, c: Config, cache: bool = True) -> DataFrame | None:
    """Writes the candidate pairs and their lists; returns the blocking recall where there is a truth."""
    s1, s2, s3 = preprocessed(spark, c)
    pool = pair.union_pool(s2, s3).drop("side")
    corpus = s1.select("entity_id", "search_text").unionByName(s2.select("entity_id", "search_text")).unionByName(s3.select("entity_id", "search_text"))
    postings = retrieval.tfidf(corpus, max_features=c.max_features)
    ids = lambda df: df.select(F.col("entity_id").alias("id")).distinct()
    sparse = retrieval.tfidf_topk(postings.join(ids(s1), "id", "left_semi"), postings.join(ids(pool), "id", "left_semi"), c.tfidf_top_k)
    search = {"Flat": retrieval.dense_topk, "IVF": retrieval.ivf_topk}.get(c.index_type)
    if search is None:
        raise ValueError(f"unknown index type {c.index_type}")
    dense = search(embedded(spark, c, "s1", s1, cache), embedded(spark, c, "pool", pool, cache), c.semantic_top_k)
    tables.write_stage(retrieval.merge_candidates(sparse, dense, c.top_n_per_entity), f"{c.cache_dir}/candidates.parquet")
    merged = tables.read_stage(spark, f"{c.cache_dir}/candidates.parquet", "block")
    tables.write_tsv(tables.candidate_lists(merged, s1), c.candidate_pairs)
    truth = truth_or_none(spark, c)
    return retrieval.blocking_recall(merged, truth) if truth is not None else None


def truth_or_none(spark: SparkSession, c: Config) -> DataFrame | None:
    try:
        return tables.truth_pairs(tables.read_truth(spark, c.ground_truth))
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def stage_features(spark: SparkSession, c: Config, labels: bool = True) -> None:
    candidates = tables.read_stage(spark, f"{c.cache_dir}/candidates.parquet", "block")
    table = pair.pair_features(candidates, *preprocessed(spark, c), c.competition_features, c.transitivity_features, c.max_pairs)
    tables.write_stage(pair.clean_features(pair.attach_labels(table, truth_or_none(spark, c) if labels else None)), f"{c.cache_dir}/features.parquet")


def stage_model(spark: SparkSession, c: Config, inference_only: bool = False) -> None:
    table = tables.read_stage(spark, f"{c.cache_dir}/features.parquet", "features")
    if not inference_only:
        matching.train(table, c.cv_n_splits, c.beta, max_iter=c.max_iter, depth=c.max_depth, rate=c.learning_rate).save(c.model_dir)
    trained = matching.MatchModel.load(spark, c.model_dir)
    tables.write_stage(trained.predict(table), f"{c.cache_dir}/predictions.parquet")


def stage_optimise(spark: SparkSession, c: Config, beta: float | None = None, skip_constraint: bool = False) -> DataFrame | None:
    """Writes the match lists; returns their evaluation where there is a truth."""
    predictions = tables.read_stage(spark, f"{c.cache_dir}/predictions.parquet", "model")
    resolved = predictions if skip_constraint or not c.constraint_resolution else decisions.resolve_constraints(predictions)
    tables.write_stage(resolved, f"{c.cache_dir}/resolved.parquet")
    beta = c.beta if beta is None else beta
    matches = decisions.optimise_matches(tables.read_stage(spark, f"{c.cache_dir}/resolved.parquet", "optimise"), preprocessed(spark, c)[0], beta=beta, k0=c.k0)
    tables.write_tsv(tables.match_lists(matches), c.matching_results)
    truth = truth_or_none(spark, c)
    return metrics.evaluation_summary(matches, truth, beta) if truth is not None else None


def output_tables(spark: SparkSession, c: Config) -> tuple[DataFrame, DataFrame]:
    return tables.read_tsv(spark, c.candidate_pairs, validation.CANDIDATE_COLUMNS, fill=True), tables.read_tsv(spark, c.matching_results, tables.TRUTH_COLUMNS, fill=True)


def stage_validate(spark: SparkSession, c: Config) -> DataFrame:
    return validation.validate(*output_tables(spark, c), preprocessed(spark, c)[0])


def smoke_test(spark: SparkSession) -> DataFrame:
    """Ten S1 and a contested candidate, resolved, optimised and validated; the table of checks."""
    rows = [(f"S1_{i:03d}", f"C_{i:03d}", 0.9 - i / 100) for i in range(8)] + [("S1_000", "C_011", 0.91), ("S1_001", "C_011", 0.75)]
    predictions = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, cal_prob double")
    ids = spark.createDataFrame([(f"S1_{i:03d}",) for i in range(10)], "entity_id string")
    resolved = decisions.resolve_constraints(predictions)
    assert resolved.where("candidate_entity_id = 'C_011'").first().source1_entity_id == "S1_000"
    matches = tables.match_lists(decisions.optimise_matches(resolved, ids))
    candidates = tables.candidate_lists(predictions.withColumn("max_score", F.col("cal_prob")), ids)
    return validation.validate(candidates, matches, ids, raise_on_error=True)


def run(spark: SparkSession, c: Config) -> DataFrame:
    """All stages; the table of checks."""
    stage_preprocess(spark, c)
    stage_block(spark, c)
    stage_features(spark, c)
    stage_model(spark, c)
    stage_optimise(spark, c)
    return stage_validate(spark, c)


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("stage", choices=["all", "preprocess", "block", "features", "model", "optimise", "validate"])
    p.add_argument("--config")
    for flag in ("no-mine", "no-cache", "no-labels", "inference-only", "skip-constraint", "summary", "smoke-test"):
        p.add_argument(f"--{flag}", action="store_true")
    p.add_argument("--beta", type=float)
    a = p.parse_args(args)
    spark, c = SparkSession.builder.appName("kinweave").getOrCreate(), Config.load(a.config)
    shown = None
    if a.stage == "preprocess":
        stage_preprocess(spark, c, not a.no_mine)
    elif a.stage == "block":
        shown = stage_block(spark, c, not a.no_cache)
    elif a.stage == "features":
        stage_features(spark, c, not a.no_labels)
    elif a.stage == "model":
        stage_model(spark, c, a.inference_only)
    elif a.stage == "optimise":
        shown = stage_optimise(spark, c, a.beta, a.skip_constraint)
    elif a.smoke_test:
        shown = smoke_test(spark)
    elif a.summary:
        shown = metrics.submission_summary(*output_tables(spark, c))
    else:
        shown = stage_validate(spark, c) if a.stage == "validate" else run(spark, c)
    if shown is not None:
        shown.show(50, truncate=False)
    failed = shown is not None and "violations" in shown.columns and shown.where("violations > 0").limit(1).count()
    return int(bool(failed))


if __name__ == "__main__":
    sys.exit(main())
