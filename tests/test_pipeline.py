import random

from kinweave.plans import catalog, fixtures, pipeline
from kinweave.sources.tables import write_tsv


def test_smoke(spark):
    assert pipeline.smoke_test(spark).where("violations > 0").count() == 0


def test_whole_pipeline(spark, tmp_path):
    r = random.Random(2)
    words = ["acme", "north", "steel", "river", "blue", "global", "union", "delta", "prime", "summit"]
    s1, s2, s3, truth = [], [], [], []
    for i in range(40):
        name = f"{r.choice(words)} {r.choice(words)} {i % 7} corporation"
        place = f"{r.randint(1, 99)} {r.choice(words)} street {10000 + i}"
        s1.append((f"a{i:02d}", name, place, "US"))
        if i % 4:
            s2.append((f"b{i:02d}", name.replace("corporation", "corp").upper(), place, "US"))
            s3.append((f"c{i:02d}", name, place.replace("street", "st"), "us"))
            truth.append((f"a{i:02d}", f"b{i:02d},c{i:02d}"))
        else:
            truth.append((f"a{i:02d}", ""))
    schema = "entity_id string, business_name string, business_address string, country string"
    paths = {k: str(tmp_path / k) for k in ("source1", "source2", "source3", "ground_truth", "cache_dir", "model_dir", "candidate_pairs", "matching_results", "dictionary")}
    for k, rows in (("source1", s1), ("source2", s2), ("source3", s3)):
        write_tsv(spark.createDataFrame(rows, schema), paths[k])
    write_tsv(spark.createDataFrame(truth, "source1_entity_id string, matched_ids string"), paths["ground_truth"])
    c = pipeline.Config(**paths, max_iter=3, max_depth=3, cv_n_splits=2, tfidf_top_k=5, semantic_top_k=5, embedding_dimensions=16)
    pipeline.stage_preprocess(spark, c)
    assert {r.noisy: r.canonical for r in spark.read.json(paths["dictionary"]).collect()} == {"corp": "corporation"}
    assert pipeline.stage_block(spark, c).first().recall > 0.95
    assert pipeline.stage_block(spark, c, cache=True).first().recall > 0.95
    pipeline.stage_features(spark, c)
    pipeline.stage_model(spark, c)
    score = pipeline.stage_optimise(spark, c).first()
    assert score.recall > 0.8
    assert pipeline.stage_validate(spark, c).where("violations > 0").count() == 0


def test_registry(spark, tiny):
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert catalog.flagship(spark, tiny).count() == 10
    assert fixtures.view(spark, tiny, fixtures.OUTPUTS).count() == 13
