"""Brute-force checks and edge cases of the operators that compare or scan texts."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from kinweave.llm import common, decontaminate, fingerprint, near_dedup, pii, secrets

EXTRA = "doc_id long, text string, source string, found string, row string, kept string, key string"


def docs(spark, texts, source="s"):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, f"{source}{i % 3}", "x", "y", "z", "k") for i, t in enumerate(texts)], EXTRA)


def edges():
    return [None, "", " \n\t ", "a", "word " * 30_000, "same text here", "same text here", "é" * 5000, "\x00", ""]


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {b" ".join(w)} if w else set()


def brute_components(texts, percent=85):
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return sets, [root(i) for i in range(len(texts))]


def near_copies(seed=4):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6)))
    base = [word() for _ in range(150)]
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(70):  # from links to the base to no link at all
        w = list(base)
        for _ in range(r.randint(0, 9)):
            w[r.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += [" ".join([word() for _ in range(r.randint(5, 60))] + passage + [word() for _ in range(r.randint(0, 40))]) for _ in range(40)]
    texts += [" ".join(word() for _ in range(r.randint(0, 8))) for _ in range(20)] + texts[:5] + [texts[0].upper()]
    return texts


def test_near_dedup_equals_brute_force(spark):
    texts = near_copies() + edges()
    sets, want = brute_components(texts)
    got = {r.doc_id: r for r in near_dedup.groups(docs(spark, texts)).collect()}
    assert len(got) == len(texts)
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == want
    assert all(got[i].kept == (want[i] == i) for i in got)


def test_near_dedup_of_nothing_and_null_ids(spark):
    assert near_dedup.groups(docs(spark, ["a"]).limit(0)).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    got = near_dedup.groups(rows).collect()
    assert len(got) == 4 and all(r.kept for r in got) and {r.component_id for r in got if r.doc_id == 3} == {3}


def test_superminhash_estimates_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(200):
        common_, own = rng.integers(0, 2**63, 120, dtype=np.uint64), rng.integers(0, 2**63, 80, dtype=np.uint64)
        sig = near_dedup.superminhash([np.concatenate([common_, own[:40]]), np.concatenate([common_, own[40:]])])
        errors.append((sig[0] == sig[1]).mean() - 120 / 200)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.065  # below plain MinHash's 0.061 plus noise
    assert (near_dedup.superminhash([np.zeros(0, np.uint64)]) == 0xFFFFFFFF).all()


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def base_secrets(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def test_secrets_equal_the_rules(spark):
    r = random.Random(2)
    bits = ["token", "Password", "api_key", "apikey", "secret", "=", ":", " ", '"', "'", "abc", "123456", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", "é𠀀", "\n", "", "", "x"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 25))) for _ in range(600)] + edges() + ["token=token: abcdefgh", "token:abc token=abcdef"]
    got = {x.doc_id: x for x in secrets.report(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = base_secrets(t or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, want, got[i].spans)
        assert got[i].n_assign == sum(w.startswith("assign") for w in want)
        assert set(want) <= set(got[i].spans.split(","))
    assert secrets.report(docs(spark, ["a"]).limit(0)).count() == 0


def test_ownership_separates_examples_from_live_values(spark):
    copied, own = "token=EXAMPLE0123456789", "my Zx9" + "aB3dE5fG7hJ9kL1mN3pQ5r key"
    rows = [(i, f"see {copied}", f"owner{i}") for i in range(8)] + [(100, own, "me"), (101, own, "me")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secrets.report(table).collect()}
    assert all(got[i].n_example == 1 and got[i].n_live == 0 and got[i].n_assign == 1 for i in range(8))
    assert got[100].n_live == 1 and got[100].spans == "generic:3:28"
    clean = {r.doc_id: r.text for r in secrets.redact(table).collect()}
    assert clean[0] == f"see {copied}" and clean[100] == "my [SECRET] key"


def test_pii_equals_the_rules(spark):
    r = random.Random(3)
    letters = "ab@.%+-1234 ()é5"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 70))) for _ in range(500)] + edges()
    texts += ["call me: 415-555-2671 or write to bob (at) mail (dot) com, ssn 123-45-6789", "order 415-555-2671, version 1.2.3.4", "1.2.3.4.5.6.7.8 a@b.c%x@d.e 0000.00255.1.2", "4111 1111 1111 1111"]
    got = {x.doc_id: x for x in pii.report(docs(spark, texts)).collect()}
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]

    def luhn(d):
        v = [int(c) for c in reversed(d)]
        return sum(c if i % 2 == 0 else (c * 2 - 9 if c > 4 else c * 2) for i, c in enumerate(v)) % 10 == 0

    for i, t in enumerate(texts):
        want = []
        for kind, pattern in rules:
            for m in re.finditer(pattern, t or ""):
                d = re.sub("[^0-9]", "", m[0])
                ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda: 13 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]
                if ok():
                    want.append(f"{kind}:{m.start()}:{m.end()}")
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, want, got[i].spans)
    n = len(texts)
    assert {s.split(":")[0] for s in got[n - 4].spans.split(",")} == {"local_phone", "spelt_email", "ssn"}
    assert got[n - 3].spans == "ip:28:35" and got[n - 1].n_card == 1
    assert got[0].n_added == 0


def test_decontamination_tolerates_substitutions(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    items = [[word() for _ in range(30)] for _ in range(12)] + [["short", "item", "of", "five", "words"]]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(50, None), (51, ""), (52, " ".join(items[0]))], "item_id long, text string")
    texts, want = [], {}
    for i in range(120):
        w = [word() for _ in range(60)]
        if i % 3 == 0:
            j = r.randrange(13)
            part = list(items[j])
            if j < 12 and i % 2:
                part[r.choice([3, 25])] = "changed"
            w[20:20] = part
            want[i] = {0, 52} if j == 0 else {j}
        texts.append(" ".join(w).title() if i % 5 == 0 else ", ".join(w))
    got = {x.doc_id: x for x in decontaminate.report(docs(spark, texts + edges()), bench).collect()}
    assert len(got) == 130
    for i in range(130):
        assert set(map(int, filter(None, got[i].item_ids.split(",")))) == want.get(i, set()), texts[i]
        assert got[i].contaminated == (i in want)
    assert decontaminate.report(docs(spark, texts), bench.limit(0)).where("contaminated").count() == 0


def test_fingerprints_estimate_generalised_jaccard(spark):
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(80)]
    texts = [" ".join(r.choice(vocabulary[: r.randint(5, 80)]) for _ in range(r.randint(1, 250))) for _ in range(150)] + edges() + ["same text here"]
    got = {x.doc_id: x for x in fingerprint.report(docs(spark, texts)).collect()}

    def jaccard(a, b):
        x, y = (Counter(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in (a, b))
        top = sum(max(x[k], y[k]) for k in set(x) | set(y))
        return sum(min(x[k], y[k]) for k in set(x) | set(y)) / top if top else 1.0

    order, errors = sorted(got, reverse=True), []
    for at, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        n = len(text)
        edited = text[: n - n // 3] + after[: n // 3]
        assert got[i].n_chars == n and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [got[i].near_edited - jaccard(text, edited), got[i].near_next - jaccard(text, after)]
    assert abs(np.mean(errors)) < 0.03 and max(map(abs, errors)) < 0.32
    same = [got[i].fingerprint for i, t in enumerate(texts) if t == "same text here"]
    assert len(set(same)) == 1 and got[150].fingerprint == "0" * 256
    assert fingerprint.report(docs(spark, ["a"]).limit(0)).count() == 0


def test_held_out_share_and_stored_tables(spark):
    table = spark.range(5000).withColumnRenamed("id", "doc_id")
    share = table.where(common.held_out(table.doc_id)).count() / 5000
    assert 0.18 < share < 0.22
    kept = common.stored(table)
    assert kept.count() == 5000
    common.forget(kept)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(kept.stored_at)


def test_names_that_are_free(spark):
    table = spark.createDataFrame([(1, 2, 3)], "key int, Key_ int, live int")
    assert common.spare(table, "key", "live", "live", "other") == ["key__", "live_", "live__", "other"]


@pytest.mark.parametrize("n", [0, 1, 7])
def test_text_slices_cover_all_rows(n):
    import pyarrow as pa

    column = pa.array(["x" * (i * 10) if i % 3 else None for i in range(n)], pa.string())
    parts = list(common.text_slices(column, 25))
    assert [t for _, _, p in parts for t in p] == column.to_pylist()
    assert [a for a, _, _ in parts] == [0, *[b for _, b, _ in parts[:-1]]][: len(parts)]
