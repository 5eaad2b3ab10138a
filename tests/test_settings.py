"""Configuration files with sections, and the score metrics' ranges."""

import json
import random

import pytest

from kinweave.operators import metrics
from kinweave.plans import pipeline


def test_sections_set_parameters(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"paths": {"source1": "x.tsv", "data_dir": "d/"}, "blocking": {"top_n_per_entity": 7, "tfidf": {"top_k": 3, "ngram_range": [2, 4]}}, "model": {"xgboost": {"n_estimators": 9}}, "postprocessing": {"f05_optimization": {"beta": 1.0}}, "seed": 42, "k0": "bernoulli"}))
    c = pipeline.Config.load(str(path))
    assert (c.source1, c.top_n_per_entity, c.tfidf_top_k, c.max_iter, c.beta, c.k0) == ("x.tsv", 7, 3, 9, 1.0, "bernoulli")
    path.write_text(json.dumps({"blocking": {"tfidf": {"ngram_range": [1, 2]}}}))
    with pytest.raises(ValueError, match="ngram_range"):
        pipeline.Config.load(str(path))
    path.write_text(json.dumps({"blocking": {"unheard_of": 1}}))
    with pytest.raises(ValueError, match="unheard_of"):
        pipeline.Config.load(str(path))


def test_average_precision_over_ranges_equals_one_pass(spark):
    r = random.Random(1)
    rows = [(round(r.random(), r.choice([1, 3, 9])), int(r.random() < 0.3)) for _ in range(500)]
    got = metrics.average_precision(spark.createDataFrame(rows, "cal_prob double, label int")).first()
    p, ap, area = sum(y for _, y in rows), 0.0, 0.0
    for s in sorted({x for x, _ in rows}, reverse=True):
        here, tp, n = sum(y for x, y in rows if x == s), sum(y for x, y in rows if x >= s), sum(x >= s for x, _ in rows)
        ap += here * tp / n
        area += (sum(x == s for x, _ in rows) - here) * (tp - here / 2)
    assert abs(got.average_precision - ap / p) < 1e-9 and abs(got.roc_auc - area / (p * (len(rows) - p))) < 1e-9
