"""Families of near copies around and below the threshold, against all pairs; and the pairs that are compared, against the family's square."""

import random

import pytest
from test_pairs_and_spans import brute_components, docs

from kinweave.llm import near_dedup


def family(n, changes, length=120, seed=1, base=None):
    r = random.Random(seed)
    base = base or [f"b{seed}x{i}" for i in range(length)]
    out = []
    for i in range(n):
        w = list(base)
        for j in r.sample(range(length), changes(r)):
            w[j] = f"e{seed}x{i}x{j}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent", [85, 80])
def test_families_equal_brute_force(spark, percent, monkeypatch):
    nested = [f"s{i}" for i in range(120)]
    texts = family(60, lambda r: r.randint(0, 6)) + family(50, lambda r: 3, seed=2)
    for k in range(4):  # families within a family
        own = list(nested)
        own[10 * k : 10 * k + 5] = [f"k{k}x{j}" for j in range(5)]
        texts += family(25, lambda r: r.randint(1, 4), seed=10 + k, base=own)
    monkeypatch.setattr(near_dedup, "SMALL_CELL", 2)
    _, want = brute_components(texts, percent)
    got = {r.doc_id: r.component_id for r in near_dedup.groups(docs(spark, texts), percent=percent).collect()}
    assert [got[i] for i in range(len(texts))] == want and len(set(want)) > 5


def test_a_family_below_the_threshold_costs_about_its_size(spark, monkeypatch):
    compared = []
    real = near_dedup.confirmed

    def counting(pairs, sets, percent):
        compared.append(pairs.count())
        return real(pairs, sets, percent)

    monkeypatch.setattr(near_dedup, "confirmed", counting)
    texts = family(400, lambda r: 3, seed=5)  # pairs have about 0.6 in common
    got = near_dedup.groups(docs(spark, texts), percent=80).collect()
    assert len({r.component_id for r in got}) > 300 and sum(compared) < 400 * 399 / 2 / 10
