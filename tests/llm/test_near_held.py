"""Buckets that are compared whole in one task, and the sifting of those that are too large for it."""

import random

import numpy as np
import pytest
from test_near_families import family
from test_pairs_and_spans import brute_components, docs

from kinweave.llm import near_dedup


def mixed():
    return family(60, lambda r: r.randint(0, 6)) + family(50, lambda r: 3, seed=2)


def test_a_bucket_of_moderate_size_makes_no_row_for_each_item(spark, monkeypatch):
    def refuse(*a):
        raise AssertionError("a row for each item of a prefix")

    monkeypatch.setattr(near_dedup, "differences", refuse)
    texts = mixed()
    _, want = brute_components(texts, 80)
    got = {r.doc_id: r.component_id for r in near_dedup.groups(docs(spark, texts), percent=80).collect()}
    assert [got[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("limit", ["HELD_CLASSES", "HELD_ITEMS"])
def test_larger_buckets_are_sifted(spark, monkeypatch, limit):
    sifted = []
    real = near_dedup.differences
    monkeypatch.setattr(near_dedup, "differences", lambda *a: sifted.append(1) or real(*a))
    monkeypatch.setattr(near_dedup, limit, 0)
    monkeypatch.setattr(near_dedup, "SMALL_CELL", 2)
    texts = mixed()
    _, want = brute_components(texts, 80)
    got = {r.doc_id: r.component_id for r in near_dedup.groups(docs(spark, texts), percent=80).collect()}
    assert [got[i] for i in range(len(texts))] == want and sifted


def test_links_by_counts_equal_set_operations(monkeypatch):
    monkeypatch.setattr(near_dedup, "HELD_BLOCK", 7)
    r = random.Random(4)
    sets = [set(r.sample(range(60), r.randint(20, 40))) for _ in range(40)]
    got = near_dedup.linked_to_first([np.array(sorted(s), np.int64) for s in sets], 50)
    want = list(range(40))
    for i in range(40):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 50 * len(sets[i] | sets[j]) and want[i] != want[j]:
                a, b = want[i], want[j]
                want = [min(a, b) if x in (a, b) else x for x in want]
    assert list(got) == want and 1 < len(set(want)) < 40
    assert list(near_dedup.linked_to_first([np.array([1, 2]), np.array([3])], 50)) == [0, 1]
