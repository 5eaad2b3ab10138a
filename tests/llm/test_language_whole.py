"""Every letter of a word and every language count."""

import random

import numpy as np

from kinweave.llm import language_id


def test_all_letters_of_a_long_word_count():
    (a, n), (b, m) = (language_id.word_features(["x" * 64 + tail, "short"]) for tail in ("abc" * 100, "def" * 100))
    assert n.tolist() == m.tolist() == [7 + 364, 7 + 5] and a[:7].tolist() != b[:7].tolist()
    field = language_id.fit([(["abc" * 4, "cab" * 3] * 10, "x"), (["def" * 4, "fed" * 3] * 10, "y")] * 40)
    head = "ghi" * 22
    names, _ = language_id.Tagger(field).label([head + "abc" * 300, head + "def" * 300])
    assert names == ["x", "y"]


def test_slices_of_a_long_word_add_up(monkeypatch):
    weights = np.random.default_rng(1).normal(size=(language_id.BUCKETS, 3)).astype(np.float32)
    field = language_id.Field(("a", "b", "c"), weights, np.zeros((3, 3)))
    words = ["".join(random.Random(i).choices("abcdefgh", k=n)) for i, n in enumerate((3, 5000, 40, 900))]
    whole = language_id.Tagger(field).emissions(words)
    monkeypatch.setattr(language_id, "GATHER", 600)
    assert np.allclose(language_id.Tagger(field).emissions(words), whole, atol=1e-2)


def test_rare_languages_are_learned(spark):
    r = random.Random(3)
    word = lambda k: "".join(chr(0x4E00 + 40 * k + r.randrange(40)) for _ in range(3))
    rows = [(70 * j + k, " ".join(word(k) for _ in range(30)), f"l{k:02d}") for k in range(70) for j in range(3 if k > 64 else 5)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    field = language_id.train(table)
    assert len(field.languages) == 70
    got = {x.doc_id: x.lang_pred for x in language_id.predict(table, field).collect()}
    assert sum(got[i] == lang for i, _, lang in rows if lang > "l64") >= 14
