import math
import random

import pytest
from pyspark.sql import functions as F

from kinweave.operators import decisions, features, metrics, model, preprocess, retrieval, validation
from kinweave.sources import tables

PAIR = "source1_entity_id string, candidate_entity_id string"


def test_mining_takes_the_rarest_duplicate(spark):
    s1 = [(f"a{i}", "main street" if i < 9 else "main station") for i in range(15)]
    other = [(f"b{i}", "main st") for i in range(15)]
    frames = [spark.createDataFrame(x, "entity_id string, norm_name string") for x in (s1, other)]
    pairs = spark.createDataFrame([(f"a{i}", f"b{i}") for i in range(15)], PAIR)
    assert preprocess.as_dictionary(preprocess.mine_substitutions(*frames, pairs)) == {"st": "station"}
    assert preprocess.as_dictionary(preprocess.mine_substitutions(*frames, pairs, prefer="most_frequent")) == {"st": "street"}
    assert preprocess.as_dictionary(preprocess.mine_substitutions(*frames, pairs, min_freq=7)) == {"st": "street"}


def test_preprocess_keeps_extra_columns_and_fills_nulls(spark):
    rows = spark.createDataFrame([(None, None, "12 Main St 94105", "US", 7)], "entity_id string, business_name string, business_address string, country string, extra int")
    r = preprocess.preprocess(rows).first()
    assert (r.entity_id, r.business_name, r.norm_name, r.search_text, r.pin_code, r.street_number, r.extra) == ("nan", "", "", "12 main st 94105", "94105", "12", 7)
    assert preprocess.preprocess(rows, pin_pattern=None).first().pin_code == ""


def test_topk_join_and_blocks_agree(spark):
    r = random.Random(3)
    rows = [(f"e{i:03d}", " ".join(r.choice(["acme", "corp", "north", "blue", "steel", "river", "st"]) + r.choice(["", "s", "x"]) for _ in range(3))) for i in range(60)]
    postings = retrieval.tfidf(spark.createDataFrame(rows, "entity_id string, search_text string")).persist()
    lengths = postings.groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert all(abs(x.n - 1) < 1e-9 for x in lengths)
    a, b = postings.where("id < 'e020'"), postings.where("id >= 'e020'")
    found = [{(x.source1_entity_id, x.candidate_entity_id, round(x.score, 6)) for x in f(a, b, 5).collect()} for f in (retrieval.topk_by_join, retrieval.topk_by_blocks)]
    assert found[0] == found[1] and len(found[0]) == 100


def test_dense_and_probed_search(spark):
    r = random.Random(5)
    rows = []
    for i in range(120):
        v = [r.gauss(0, 1) for _ in range(8)]
        n = math.sqrt(sum(x * x for x in v))
        rows.append((f"v{i:03d}", [x / n for x in v]))
    table = spark.createDataFrame(rows, "id string, vector array<float>")
    a, b = table.where("id < 'v020'"), table.where("id >= 'v020'")
    exact = {(x.source1_entity_id, x.candidate_entity_id) for x in retrieval.dense_topk(a, b, 3).collect()}
    vectors = dict(rows)
    for q in ("v000", "v011"):
        want = sorted((k for k in vectors if k >= "v020"), key=lambda k: -sum(x * y for x, y in zip(vectors[q], vectors[k], strict=True)))[:3]
        assert {c for s, c in exact if s == q} == set(want)
    every_cell = {(x.source1_entity_id, x.candidate_entity_id) for x in retrieval.ivf_topk(a, b, 3, nlist=4, nprobe=4).collect()}
    assert every_cell == exact
    some = {(x.source1_entity_id, x.candidate_entity_id) for x in retrieval.ivf_topk(a, b, 3, nlist=4, nprobe=2).collect()}
    assert len(some & exact) / len(exact) > 0.5


def test_merge_fills_zero_and_caps(spark):
    a = spark.createDataFrame([("s", "c1", 0.5), ("s", "c2", 0.9)], PAIR + ", score double")
    b = spark.createDataFrame([("s", "c1", 0.7), ("s", "c3", 0.2)], PAIR + ", score double")
    got = [(r.candidate_entity_id, r.tfidf_score, r.sem_score, r.max_score) for r in retrieval.merge_candidates(a, b, 2).orderBy(F.desc("max_score")).collect()]
    assert got == [("c2", 0.9, 0.0, 0.9), ("c1", 0.5, 0.7, 0.7)]
    assert retrieval.blocking_recall(a, a.limit(0)).first().recall == 1.0


def test_margins_are_gaps_to_the_next(spark):
    rows = spark.createDataFrame([("a", "c", 0.9, 0.0), ("b", "c", 0.7, 0.0), ("d", "c", 0.2, 0.0)], PAIR + ", sem_score double, tfidf_score double")
    got = features.competition_features(rows).orderBy("rank_among_s1").collect()
    assert [round(r.margin_sem, 9) for r in got] == [0.2, 0.5, 0.0] and [r.n_competing_s1 for r in got] == [3, 3, 3]


def test_transitivity_of_one(spark):
    rows = spark.createDataFrame([("a", "c", 0.9, 0.5, "x")], PAIR + ", sem_score double, jaro_winkler_name double, cand_norm_name string")
    ids = spark.createDataFrame([("c",)], "entity_id string")
    r = features.transitivity_features(rows, ids, ids.limit(0)).first()
    assert (r.trans_n_candidates, r.trans_std_sem, r.trans_cross_source_sim) == (1, 0.0, 0.0)
    assert features.transitivity_features(rows, ids, ids).first().trans_cross_source_sim == 1.0


def test_constraint_conflicts_and_ties(spark):
    p = spark.createDataFrame([("S1_001", "C_011", 0.75), ("S1_000", "C_011", 0.91), ("S1_005", "x", 0.5), ("S1_004", "x", 0.5), ("S1_009", "y", float("nan")), ("S1_008", "y", 0.1)], PAIR + ", cal_prob double")
    got = {r.candidate_entity_id: r.source1_entity_id for r in decisions.resolve_constraints(p).collect()}
    assert got == {"C_011": "S1_000", "x": "S1_004", "y": "S1_008"}


def expected_f(p, k, beta=0.5):
    p = sorted(p, reverse=True)
    total, top = sum(p), sum(p[:k])
    if k == 0:
        return 1.0 if total < 1e-6 else 0.0
    if top < 1e-6:
        return 0.0
    precision, recall = top / k, top / total
    return (1 + beta**2) * precision * recall / (beta**2 * precision + recall)


def test_best_list_is_the_first_maximum(spark):
    r = random.Random(1)
    lists = {f"s{i:02d}": [round(r.random() ** 3, 4) for _ in range(r.randint(1, 12))] for i in range(40)} | {"zero": [0.0, 0.0], "low": [0.05], "four": [0.95, 0.80, 0.10, 0.05]}
    rows = spark.createDataFrame([(s, f"{s}_{j}", p) for s, ps in lists.items() for j, p in enumerate(ps)], PAIR + ", cal_prob double")
    ids = spark.createDataFrame([(s,) for s in [*lists, "none"]], "entity_id string")
    got = {x.source1_entity_id: x for x in decisions.optimise_matches(rows, ids).collect()}
    for s, ps in lists.items():
        scores = [expected_f(ps, k) for k in range(len(ps) + 1)]
        best = max(scores)
        assert abs(got[s].best_ef05 - best) < 1e-9
        assert got[s].best_k == next(k for k, v in enumerate(scores) if v > best - 1e-11)
    assert (got["none"].best_k, got["none"].best_ef05, got["none"].matched_ids) == (0, 1.0, [])
    assert (got["zero"].best_k, got["zero"].best_ef05, got["low"].best_k, got["four"].best_k) == (0, 1.0, 1, 2)
    assert abs(got["four"].best_ef05 - 0.8838) < 1e-4
    assert {x.source1_entity_id: x for x in decisions.optimise_matches(rows, ids, k0="bernoulli").collect()}["low"].best_k == 0


def test_the_two_metrics_differ_for_a_singleton(spark):
    rows = spark.createDataFrame([("s", "c", 0.9, 0)], PAIR + ", cal_prob double, label int")
    assert metrics.macro_f(rows, 0.5).first().macro_f == 1.0
    matches = spark.createDataFrame([("s", ["c"])], "source1_entity_id string, matched_ids array<string>")
    truth = rows.select("source1_entity_id", "candidate_entity_id").limit(0)
    assert metrics.evaluate(matches, truth).first().f == 0.0
    assert metrics.evaluate(matches.withColumn("matched_ids", F.array().cast("array<string>")), truth).first().f == 1.0
    assert metrics.best_threshold(rows.withColumn("label", F.lit(1)), 50).first()[:] == (pytest.approx(0.01), 1.0)


def test_average_precision_needs_both_classes(spark):
    rows = spark.createDataFrame([("s", "a", 0.9, 1), ("s", "b", 0.8, 0), ("s", "c", 0.7, 1)], PAIR + ", cal_prob double, label int")
    r = metrics.average_precision(rows).first()
    assert r.average_precision == pytest.approx((1 + 2 / 3) / 2) and r.roc_auc == pytest.approx(0.5)
    assert metrics.average_precision(rows.where("label = 1")).first()[:] == (0.0, 0.0)


def test_folds_keep_groups_together(spark):
    rows = spark.createDataFrame([(f"s{i % 53}", f"c{i}") for i in range(400)], PAIR)
    folds = model.group_folds(rows, 5)
    assert folds.count() == 400
    per = folds.select("source1_entity_id", "fold").distinct().groupBy("fold").count().collect()
    assert sum(r["count"] for r in per) == 53 and max(r["count"] for r in per) - min(r["count"] for r in per) <= 1


def test_isotonic_pools_ties_and_clips(spark):
    rows = spark.createDataFrame([(0.2, 0), (0.2, 1), (0.2, 0), (0.8, 1)], "raw_prob double, label int")
    fitted = model.calibrator(rows)
    at = {r.raw_prob: r.cal_prob for r in model.calibrated(fitted, spark.createDataFrame([(0.0,), (0.2,), (0.5,), (1.0,)], "raw_prob double")).collect()}
    assert at == {0.0: pytest.approx(1 / 3), 0.2: pytest.approx(1 / 3), 0.5: pytest.approx(2 / 3), 1.0: 1.0}


def test_checks(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "entity_id string")
    cands = spark.createDataFrame([("a", "x,y"), ("b", ""), ("d", "z")], "source1_entity_id string, candidate_entity_ids string")
    good = spark.createDataFrame([("a", "x"), ("b", ""), ("c", "")], "source1_entity_id string, matched_ids string")
    bad = spark.createDataFrame([("a", "x,x"), ("b", "x"), ("b", "['q']")], "source1_entity_id string, matched_ids string")
    assert {(r[0], r[1]) for r in validation.coverage(cands, ids).collect()} == {("c", "missing"), ("d", "extra")}
    assert validation.outside_candidates(good, cands).count() == 0
    assert validation.outside_candidates(bad, cands).count() == 2 and validation.outside_candidates(bad, cands, lenient=True).count() == 0
    report = {r.check: r.violations for r in validation.validate(cands, bad, ids).collect()}
    assert report["repeated_matches"] == 1 and report["single_owner"] == 1 and report["match_format"] == 1 and report["row_counts"] == 0
    with pytest.raises(validation.InvalidOutput):
        validation.validate(cands, bad, ids, raise_on_error=True)
    assert validation.validate(cands.drop("candidate_entity_ids"), good, ids).where("violations > 0").count() == 1


def test_tsv_round_trip(spark, tmp_path):
    path = tmp_path / "in.tsv"
    path.write_bytes("﻿entity_id\t business_name\tbusiness_address\tcountry\textra\n1\t\"a\tb\"\tNA\tNA\tx\n2\tnone\tcaf".encode() + b"\xff" + "\tDE\t\n".encode())
    rows = {r.entity_id: r for r in tables.read_records(spark, str(path)).collect()}
    assert (rows["1"].business_name, rows["1"].business_address, rows["1"].country, rows["1"].extra) == ("a\tb", None, None, "x")
    assert (rows["2"].business_name, rows["2"].business_address) == ("none", "caf")
    assert tables.read_tsv(spark, str(path), na_words=False).where("country = 'NA'").count() == 1
    with pytest.raises(tables.MissingColumns):
        tables.read_truth(spark, str(path))
    out = str(tmp_path / "out")
    ids = spark.createDataFrame([("a",), ("b",)], "entity_id string")
    cands = spark.createDataFrame([("a", "y", 0.1), ("a", "x", 0.9)], PAIR + ", max_score double")
    tables.write_tsv(tables.candidate_lists(cands, ids).orderBy("source1_entity_id"), out)
    text = next(p for p in (tmp_path / "out").iterdir() if p.suffix == ".csv").read_text()
    assert text == "source1_entity_id\tcandidate_entity_ids\na\tx,y\nb\t\n"
    with pytest.raises(FileNotFoundError):
        tables.read_stage(spark, str(tmp_path / "nothing"), "block")
    tables.write_dictionary({"b": "é", "a": "x"}, str(tmp_path / "d.json"))
    assert tables.read_dictionary(str(tmp_path / "d.json")) == {"a": "x", "b": "é"}
