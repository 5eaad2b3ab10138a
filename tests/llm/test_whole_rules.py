"""Broken pages, benchmark items by length, shared ids, label sequences, and one table of odd rows through every operator."""

import itertools
import random
import time

import numpy as np
import pytest

import corpus_pipeline
from kinweave.llm import common, decontaminate, fingerprint, language_id, licenses, near_dedup, pii, quality, secrets, sentencepiece_bpe, warc
from kinweave.llm.queries import sentencepiece_model


@pytest.mark.parametrize("bit", ["<script>", "<!--", "<title>", "<a", '<a href="', "<a href='x ", "<html ", "<p", "</script ", "<html lang ", "<!-->", "&", "<a href=x><!--"])
def test_broken_pages_cost_one_pass(bit):
    page = bit * (1_000_000 // len(bit))
    start = time.perf_counter()
    records = warc.derive("<urn:uuid:1>", "http://h", warc.DATE, "", page)
    assert len(records) == 2 and time.perf_counter() - start < 8


def test_hidden_parts_and_links():
    page = '<title>T</title><body><!-- a <script> b -->c<SCRIPT>x</script >d<style>e<p>f<a data-href="n" href="u&amp;v">g</a><a href=w>h</a><a name=q>i</a><script>j'
    assert warc.plain_text(page) == "Tcde\nfghij".replace("cde", "c d e").replace("fghij", "f g h i j").replace("Tc", "T c")
    assert warc.outlinks(page) == ["u&v", "w"] and warc.title(page) == "T" and warc.language('<html><html dir=x LANG="fr-CA">') == "fr-ca"


def test_serialised_records_keep_the_source():
    record = warc.derive("<urn:uuid:1>", "http://h", warc.DATE, "HTTP/1.1 200 OK\nX-Y: z", "<p>hi</p>")[1]
    (headers, block), = warc.parse(warc.serialise(record))
    assert headers["warc-refers-to"] == "<urn:uuid:1>" and headers["warc-refers-to-payload-digest"] == warc.digest(b"<p>hi</p>")
    assert headers["warc-refers-to-header"] == "HTTP/1.1 200 OK\nX-Y: z" and headers["warc-refers-to-target-uri"] == "http://h" and block == b"hi"


def sliding(doc, item):
    """Whether a window of the item has enough equal tokens at some place of the document; no seeds."""
    width = min(decontaminate.WINDOW, len(item))
    needed = decontaminate.EQUAL if len(item) >= decontaminate.WINDOW else -(-width * decontaminate.EQUAL // decontaminate.WINDOW)
    if len(item) < len(decontaminate.MASKS[0]):
        needed = width
    for shift in range(-width, len(doc)):
        for s in range(len(item) - width + 1):
            if sum(0 <= shift + j < len(doc) and doc[shift + j] == item[j] for j in range(s, s + width)) >= needed:
                return True
    return False


def substituted():
    """Documents that hold an item of 5 to 20 tokens with every choice of up to two changed tokens that the rule allows, and others."""
    items = {n: [f"i{n}x{j}" for j in range(n)] for n in (5, 8, 9, 10, 11, 12, 13, 16, 20)}
    docs = []
    for n, item in items.items():
        allowed = 2 if n >= 13 else 1
        for k in range(allowed + 2):
            for places in itertools.islice(itertools.combinations(range(n), k), 0, None, 1 if k < 2 else 7):
                docs.append(["before", "it", *("changed" if j in places else w for j, w in enumerate(item)), "after", "all"])
    return items, docs


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_SEEDS, 0])
def test_seeds_find_what_a_sliding_comparison_finds(spark, limit):
    items, docs = substituted()
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontaminate.report(table, bench, broadcast_seeds=limit).collect()}
    wanted = {i: ",".join(str(n) for n, w in items.items() if sliding(d, w)) for i, d in enumerate(docs)}
    real = [i for i in wanted if wanted[i]]
    assert all(not got[i] for i in wanted if not wanted[i])
    for n in items:
        of = [i for i in real if wanted[i] == str(n)]
        assert sum(got[i] == wanted[i] for i in of) >= 0.97 * len(of), n
        if n in (9, 10, 11, 12):
            assert all(got[i] == wanted[i] for i in of), n


def test_shared_ids_link_what_their_texts_link_with(spark):
    words = lambda k: [f"{k}{i}" for i in range(60)]
    near = lambda k: " ".join([*words(k)[:-2], "x", "y"])
    rows = [(5, " ".join(words("a"))), (5, " ".join(words("b"))), (2, near("a")), (3, near("b")), (9, " ".join(words("c"))), (9, None), (8, "alone")]
    got = [(r.doc_id, r.component_id, r.kept) for r in near_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == [(2, 2, True), (3, 2, False), (5, 2, False), (5, 2, False), (8, 8, True), (9, 9, True), (9, 9, True)]
    table = spark.createDataFrame([(*r, "e") for r in [(1, "one text"), (1, "two text"), (1, "two text"), (4, "x")]], "doc_id long, text string, doc_key string")
    for _ in range(2):
        kept = corpus_pipeline.near_duplicates(spark, table, "").collect()
        assert sorted((r.doc_id, r.text) for r in kept) == [(1, "two text"), (4, "x")]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(7)
    emission, transitions = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    length = np.array([4, 1, 4])
    got = language_id.posteriors(emission, length, transitions)
    at = 0
    for n in length:
        total = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight = np.exp(sum(emission[at + i, y] for i, y in enumerate(path)) + sum(transitions[a, b] for a, b in itertools.pairwise(path)))
            for i, y in enumerate(path):
                total[i, y] += weight
        assert np.allclose(got[at : at + n], total / total.sum(axis=1, keepdims=True))
        at += n


def test_places_that_no_term_wins_read_zero(spark):
    """With the bound of the module a place is empty in one of 10^8 cases; with a far lower one the share follows exp(-sure)."""
    terms = spark.range(4000).selectExpr("id div 20 as k", "xxhash64(id) as term", "cast(1 as bigint) as weight", "20 as total")
    counts = [fingerprint.sampled(terms, ["k"], sure).select("k", "place").distinct().count() for sure in (fingerprint.SURE, 1.0)]
    assert counts[0] == 200 * fingerprint.SAMPLES
    # the bound lies below a, so that fewer places are empty than exp(-1) of them
    assert counts[0] * (1 - np.exp(-1)) * 0.98 < counts[1] < counts[0]


def test_blocks_of_any_keys(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    text = lambda: " ".join(r.choice(words) for _ in range(r.randint(0, 12)))
    rows = [(i, text()) for i in range(150)] + [(10**15, "far off"), (-(2**63), "least")] + [(None, text()) for _ in range(60)] + [(7, text()) for _ in range(60)] + [(8, "same same")] * 60
    table = spark.createDataFrame(rows, "doc_id long, text string")
    plain = sorted(map(str, fingerprint.report(table, block=10**6).collect()))
    assert sorted(map(str, fingerprint.report(table, block=8).collect())) == plain and len(plain) == len(rows)
    bounds = fingerprint.block_bounds(table.select(fingerprint.F.col("doc_id").alias("id"), fingerprint.F.xxhash64("text").alias("h"), fingerprint.F.monotonically_increasing_id().alias("r")), 8)
    assert len(bounds) > 10
    named = spark.createDataFrame([("b", "x y"), ("a", "x y z"), (None, None)], "doc_id string, text string")
    assert [x.n_chars for x in fingerprint.report(named, block=1).orderBy(fingerprint.F.desc_nulls_last("doc_id")).collect()] == [3, 5, 0]


ODD = [None, "", " \n\t ", "a", "0", "word " * 20_000, "x" * 100_000, "same text of seven words in all", "same text of seven words in all", "\x00", "é𠀀 ñ ß", 'token = "abcdef0123456789abcdef01"', "1.2.3.4 a@b.c +1 (415) 555-2671"]
CLASHES = ("key", "key_", "row", "id", "found", "live", "spans", "block", "text_", "at", "ids", "score", "label", "items", "h", "n", "kept", "doc_key")


def odd_table(spark, tiny):
    documents = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = [(None if i % 5 == 4 else i % 9, t, "en" if i % 2 else None, "s", 1) for i, t in enumerate([*ODD, *ODD])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(*documents.columns, *[common.F.lit(1).alias(c) for c in CLASHES])


def operators(spark, tiny):
    bench, labels = spark.read.parquet(f"{tiny}/benchmark.parquet"), spark.read.parquet(f"{tiny}/labels.parquet")
    vocabulary = sentencepiece_bpe.Vocabulary.load(sentencepiece_model())
    return {
        "secrets": secrets.report, "redacted secrets": secrets.redact, "encoded": lambda d: sentencepiece_bpe.encode_decode(d, vocabulary), "licenses": licenses.report, "fingerprints": fingerprint.report,
        "quality": lambda d: quality.score(d, quality.train(d, labels)), "pii": pii.report, "redacted pii": pii.redact,
        "warc": lambda d: warc.derivatives(warc.responses(d, "doc_id", "source", "text")).where("record_type = 'metadata'"), "language": lambda d: language_id.predict(d, language_id.train(d)),
        "near": near_dedup.groups, "contaminated": lambda d: decontaminate.report(d, bench),
    }


def test_odd_rows_and_empty_tables(spark, tiny):
    table = odd_table(spark, tiny)
    for name, f in operators(spark, tiny).items():
        assert f(table).count() == len(ODD) * 2, name
        assert f(table.limit(0)).count() == 0, name


def test_pipeline_of_odd_rows_and_of_nothing(spark, tiny):
    table = odd_table(spark, tiny)
    for docs, least in ((table, 1), (table.limit(0), 0)):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            rows = common.stored(stage(spark, rows, tiny))
            if name != "sentencepiece":
                assert rows.columns == docs.columns, name
        assert rows.count() >= least


def test_checkpoints_need_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Far:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()

    class Session:
        sparkContext = Far()
        conf = type("C", (), {"get": lambda self, k, d=None: d})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.checkpoint_dir(Session())
