"""Rows without an id keep what is decided about their texts."""

import corpus_pipeline
from kinweave.llm import decontaminate, licenses, secrets

SCHEMA = "doc_id long, text string, source string"
TOKEN = 'token = "abcdef0123456789abcdef01"'


def test_decisions_reach_rows_without_an_id(spark, tiny):
    item = spark.read.parquet(f"{tiny}/benchmark.parquet").orderBy("item_id").first().text
    texts = [f"some words before {item} and after", "Released under the MIT License.", f"the {TOKEN} here", "plain words", None]
    table = spark.createDataFrame([(None, t, "s") for t in texts] + [(1, texts[0], "s"), (2, texts[3], "s")], SCHEMA)
    bench = spark.read.parquet(f"{tiny}/benchmark.parquet")
    found = decontaminate.report(table, bench).collect()
    assert sorted((str(r.doc_id), r.contaminated) for r in found) == [("1", True), ("2", False), *[("None", False)] * 4, ("None", True)]
    assert sorted((str(r.doc_id), r.licenses) for r in licenses.report(table).collect()) == [("1", ""), ("2", ""), *[("None", "")] * 4, ("None", "MIT")]
    clean = [r.text for r in secrets.redact(table).collect()]
    assert len(clean) == 7 and 'the [SECRET]" here' in clean and not any("abcdef01" in (t or "") for t in clean)
    kept = corpus_pipeline.decontaminated(spark, table, tiny)
    assert kept.columns == table.columns and sorted(str(r.text) for r in kept.collect()) == sorted(map(str, [*texts[1:], texts[3]]))
