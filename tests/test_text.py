import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinweave.functions import similarity as sim
from kinweave.functions import text as tx


def one(spark, row, *columns, schema=None):
    return spark.createDataFrame([row], schema or ", ".join(f"c{i} string" for i in range(len(row)))).select(*columns).first()


def plain(text):
    kept = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) != "Mn")
    out = "".join(c if c.isascii() and (c.isalnum()) else " " for c in kept)
    return " ".join(out.split())


def test_normalise_cases(spark):
    cases = {None: "", "S.A.": "s a", "Société Générale": "societe generale", "é": "e", "Straße": "stra e", "  A--b ": "a b"}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", tx.normalise(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in rows} == cases


def test_normalise_every_character(spark):
    points = [p for p in range(1, 0x3000) if not 0xD800 <= p < 0xE000]
    rows = spark.createDataFrame([(p, f"a{chr(p)}B") for p in points], "p int, t string").select("p", "t", tx.normalise(F.col("t")).alias("n")).collect()
    assert [hex(r.p) for r in rows if r.n != plain(r.t)] == []


def test_numbers(spark):
    a = F.col("c0")
    assert one(spark, ("12 main street 94105 san francisco",), tx.pin_code(a), tx.street_number(a))[:] == ("94105", "12")
    assert one(spark, ("1010 vienna",), tx.pin_code(a), tx.street_number(a))[:] == ("1010", "1010")
    assert one(spark, ("no digits",), tx.pin_code(a), tx.street_number(a))[:] == ("", "")


def test_replace_is_whole_token_and_not_recursive(spark):
    t = F.col("c0")
    assert one(spark, ("acme corp ltd",), tx.replace_tokens(t, {"corp": "corporation", "ltd": "limited"}))[0] == "acme corporation limited"
    assert one(spark, ("a",), tx.replace_tokens(t, {"a": "ab", "ab": "abc"}))[0] == "ab"
    assert one(spark, ("a  b",), tx.replace_tokens(t, {}))[0] == "a  b"


def test_id_lists_and_format(spark):
    assert one(spark, (" a, ,b ",), tx.id_list(F.col("c0")))[0] == ["a", "b"]
    for empty in (None, "", "NaN", "none"):
        assert one(spark, (empty,), tx.id_list(F.col("c0")))[0] == []
    bad = {"['a']": True, "a , b": True, "a,,b": False, "": False, "nan": False}
    for cell, want in bad.items():
        assert one(spark, (cell,), tx.badly_formatted(F.col("c0")))[0] is want


def test_word_grams(spark):
    def want(text):
        out = []
        for w in text.split():
            w = f" {w} "
            for n in range(2, 5):
                out += [w[i : i + n] for i in range(len(w) - n + 1)] or [w]
                if len(w) <= n:
                    break
        return out

    for t in ("a", "ab", "abc", "acme corp", "x yz", ""):
        assert one(spark, (t,), tx.word_grams(F.col("c0")))[0] == want(t)


def test_similarity_edges(spark):
    a, b = F.col("c0"), F.col("c1")
    functions = (sim.levenshtein_similarity, sim.token_jaccard, sim.length_ratio, sim.jaro_winkler)
    for f in functions:
        assert one(spark, ("", ""), f(a, b))[0] == 1.0
        assert one(spark, ("", "x"), f(a, b))[0] == 0.0
    assert abs(one(spark, ("acme corporation limited", "acme corp ltd"), sim.token_jaccard(a, b))[0] - 0.2) < 1e-12
    assert one(spark, ("", ""), sim.country_match(a, b))[0] == 0


def test_jaro_winkler_threshold():
    assert sim.jaro_winkler_value("abcdefgh", "abxxxxxx") == 0.5
    assert abs(sim.jaro_winkler_value("martha", "marhta") - 0.9611111) < 1e-6


@settings(max_examples=200, deadline=None)
@given(st.text("abcdé ", max_size=12), st.text("abcdé ", max_size=12))
def test_jaro_winkler_properties(a, b):
    v = sim.jaro_winkler_value(a, b)
    assert 0 <= v <= 1 + 1e-12
    assert abs(v - sim.jaro_winkler_value(b, a)) < 1e-9 or len(a) == len(b)


def test_number_veto_missing_never_conflicts(spark):
    columns = sim.number_veto(*(F.col(f"c{i}") for i in range(6)))
    assert one(spark, ("1 a 94105", "1 a", "", "", "", ""), *columns)[:] == (0, 0, 0)
    assert one(spark, ("1 a 94105", "2 a 94106", "", "", "", ""), *columns)[:] == (1, 1, 1)
    assert one(spark, ("1 a 94105", "1 a 94106", "7777", "7777", "", ""), *columns)[:] == (0, 0, 0)
