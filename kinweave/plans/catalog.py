"""Registered queries of the entity-resolution operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions import similarity as sim
from kinweave.functions import text as tx
from kinweave.operators import decisions, features, metrics, model, preprocess, retrieval, validation
from kinweave.plans import fixtures as fx
from kinweave.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name."""

    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def norm(e: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower(coalesce({e}, ''))), '[^a-z0-9]+', ' ', 'g'))"


PREP = f"""
recs AS ({fx.RECORDS}),
prep0 AS (SELECT entity_id, src, p_name, p_brand, p_type, {norm("business_name")} AS norm_name, {norm("business_address")} AS norm_address, {norm("country")} AS norm_country FROM recs),
prep AS (SELECT *, trim(concat_ws(' ', norm_name, norm_address)) AS search_text, regexp_extract(norm_address, '\\b\\d{{4,7}}\\b') AS pin_code, regexp_extract(norm_address, '\\b\\d{{1,4}}[a-z]?\\b') AS street_number FROM prep0)
"""
PREDS = f"preds AS ({fx.PREDICTIONS})"
RESOLVED = f"""{PREDS},
resolved AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate_entity_id ORDER BY cal_prob DESC, source1_entity_id) AS r FROM preds) WHERE r = 1)"""
SCAN = f"""{RESOLVED},
scan AS (
  SELECT source1_entity_id, candidate_entity_id, cal_prob AS prob, k, top_sum, total,
    CASE WHEN top_sum < 1e-6 THEN 0 ELSE 1.25 * top_sum / (0.25 * greatest(total, 1e-6) + k) END AS score
  FROM (SELECT *, row_number() OVER o AS k, sum(cal_prob) OVER (o ROWS UNBOUNDED PRECEDING) AS top_sum, sum(cal_prob) OVER (PARTITION BY source1_entity_id) AS total
    FROM resolved WINDOW o AS (PARTITION BY source1_entity_id ORDER BY cal_prob DESC, candidate_entity_id))
)"""
CHOSEN = f"""{SCAN},
best AS (SELECT source1_entity_id, k, score, total FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY round(score, 12) DESC, k) AS r FROM scan) WHERE r = 1),
ids AS (SELECT concat('s', s_suppkey) AS source1_entity_id FROM supplier),
chosen AS (
  SELECT i.source1_entity_id, CASE WHEN b.k IS NULL OR b.total < 1e-6 OR b.score <= 0 THEN 0 ELSE b.k END::BIGINT AS best_k,
    CASE WHEN b.k IS NULL OR b.total < 1e-6 THEN 1 ELSE greatest(b.score, 0) END AS best_ef05
  FROM ids i LEFT JOIN best b USING (source1_entity_id)
)"""
LISTS = f"""{CHOSEN},
lists AS (
  SELECT c.source1_entity_id, coalesce(string_agg(s.candidate_entity_id, ',' ORDER BY s.k), '') AS matched_ids, any_value(c.best_k) AS best_k, any_value(c.best_ef05) AS best_ef05
  FROM chosen c LEFT JOIN scan s ON s.source1_entity_id = c.source1_entity_id AND s.k <= c.best_k GROUP BY c.source1_entity_id
)"""
OUT = f"outputs AS ({fx.OUTPUTS}), out_ids AS ({fx.OUTPUT_IDS})"


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.view(spark, sf_dir, fx.PREDICTIONS)


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("s"), "s_suppkey").alias("entity_id"))


def prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess.preprocess(fx.view(spark, sf_dir, fx.RECORDS))


def label_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preds(spark, sf_dir).where("label = 1").select("source1_entity_id", "candidate_entity_id")


def sides(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(records.where(F.col("src") == i) for i in (1, 2, 3))


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = preds(spark, sf_dir)
    return retrieval.merge_candidates(
        p.where("tfidf_score > 0.3").withColumn("score", F.col("tfidf_score")), p.where("sem_score > 0.5").withColumn("score", F.col("sem_score"))
    )


MERGED = f"""{PREDS},
merged AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY round(max_score, 9) DESC, candidate_entity_id) AS r FROM (
      SELECT source1_entity_id, candidate_entity_id, coalesce(a.tfidf_score, 0) AS tfidf_score, coalesce(b.sem_score, 0) AS sem_score, greatest(coalesce(a.tfidf_score, 0), coalesce(b.sem_score, 0)) AS max_score
      FROM (SELECT * FROM preds WHERE tfidf_score > 0.3) a FULL JOIN (SELECT * FROM preds WHERE sem_score > 0.5) b USING (source1_entity_id, candidate_entity_id)
    ) WHERE max_score > 0
  ) WHERE r <= 50
)"""


# Text and records


@query(f"SELECT doc_id, {norm('text')} AS norm_text FROM documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", tx.normalise(F.col("text")).alias("norm_text"))


@query(f"WITH {PREP} SELECT entity_id, norm_name, norm_address, norm_country, search_text, pin_code, street_number FROM prep")
def preprocess_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep(spark, sf_dir).select("entity_id", *preprocess.DERIVED)


@query(f"WITH {PREP} SELECT entity_id, pin_code, street_number, len(list_distinct(regexp_extract_all(norm_address, '\\b\\d{{4,7}}\\b')))::BIGINT AS n_numbers FROM prep")
def extract_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fx.view(spark, sf_dir, fx.RECORDS).withColumn("a", tx.normalise(F.col("business_address")))
    return out.select("entity_id", tx.pin_code(F.col("a")).alias("pin_code"), tx.street_number(F.col("a")).alias("street_number"), F.size(tx.all_numbers(F.col("a"))).cast("long").alias("n_numbers"))


@query(f"WITH {PREP} SELECT count(*) AS rows, (count(*) - count(DISTINCT entity_id)) AS duplicate_ids, count(*) FILTER (search_text = '') AS blank_search_text FROM prep")
def record_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess.quality_report(prep(spark, sf_dir))


MINED = f"""{PREP}, truth AS ({fx.TRUTH}),
toks AS (SELECT a.source1_entity_id AS s, a.candidate_entity_id AS c, list_distinct(string_split(x.norm_name, ' ')) AS cn, list_distinct(string_split(y.norm_name, ' ')) AS nn
  FROM truth a JOIN prep x ON x.entity_id = a.source1_entity_id JOIN prep y ON y.entity_id = a.candidate_entity_id),
pairs AS (SELECT n, unnest(list_filter(cn, lambda v: NOT list_contains(nn, v))) AS c FROM (SELECT cn, nn, unnest(list_filter(nn, lambda v: NOT list_contains(cn, v))) AS n FROM toks)),
counts AS (SELECT n AS noisy, c AS canonical, count(*) AS freq FROM pairs WHERE length(n) >= 2 AND length(n) < length(c) AND starts_with(c, n) GROUP BY n, c),
top AS (SELECT *, row_number() OVER (ORDER BY freq DESC, noisy, canonical) AS r FROM counts),
mined AS (SELECT noisy, canonical, freq FROM (SELECT *, row_number() OVER (PARTITION BY noisy ORDER BY freq, canonical DESC) AS q FROM top WHERE r <= 200 AND freq >= 5) WHERE q = 1)"""


def mined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    records = prep(spark, sf_dir)
    return records, preprocess.mine_substitutions(records.where("src = 1"), records.where("src > 1"), fx.view(spark, sf_dir, fx.TRUTH))


@query(f"WITH {MINED} SELECT noisy, canonical, freq FROM mined")
def mine_substitutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(spark, sf_dir)[1]


@query(f"""WITH {MINED}, t AS (SELECT entity_id, string_split(norm_name, ' ') AS w FROM prep),
u AS (SELECT entity_id, unnest(w) AS tok, unnest(range(len(w))) AS i FROM t)
SELECT u.entity_id, string_agg(coalesce(m.canonical, u.tok), ' ' ORDER BY u.i) AS expanded FROM u LEFT JOIN mined m ON m.noisy = u.tok GROUP BY u.entity_id""")
def token_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, table = mined(spark, sf_dir)
    return records.select("entity_id", tx.replace_tokens(F.col("norm_name"), preprocess.as_dictionary(table)).alias("expanded"))


JW = "CASE WHEN {a} = {b} THEN 1 WHEN {a} = '' OR {b} = '' THEN 0 ELSE jaro_winkler_similarity({a}, {b}) END"
LEV = "CASE WHEN {a} = '' AND {b} = '' THEN 1 WHEN {a} = '' OR {b} = '' THEN 0 ELSE 1 - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b})) END"
RATIO = "CASE WHEN {a} = '' AND {b} = '' THEN 1 WHEN {a} = '' OR {b} = '' THEN 0 ELSE least(length({a}), length({b}))::DOUBLE / greatest(length({a}), length({b})) END"
TOK = "list_distinct(list_filter(string_split({a}, ' '), lambda v: v <> ''))"
COMMON = f"len(list_intersect({TOK.format(a='{a}')}, {TOK.format(a='{b}')}))"
JAC = f"CASE WHEN {{a}} = '' AND {{b}} = '' THEN 1 ELSE {COMMON}::DOUBLE / len(list_distinct(list_concat({TOK.format(a='{a}')}, {TOK.format(a='{b}')}))) END"
PAIRED = f"""{PREP}, truth AS ({fx.TRUTH}), paired AS (
  SELECT t.source1_entity_id, t.candidate_entity_id, x.norm_name AS a, y.norm_name AS b, x.norm_address AS aa, y.norm_address AS ba, x.norm_country AS ac, y.norm_country AS bc,
    x.pin_code AS ap, y.pin_code AS bp, x.street_number AS ast, y.street_number AS bst
  FROM truth t JOIN prep x ON x.entity_id = t.source1_entity_id JOIN prep y ON y.entity_id = t.candidate_entity_id)"""


def paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = prep(spark, sf_dir)
    side = lambda key, i: records.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{c}_{i}") for c in preprocess.DERIVED])
    return fx.view(spark, sf_dir, fx.TRUTH).join(side("source1_entity_id", 1), "source1_entity_id").join(side("candidate_entity_id", 2), "candidate_entity_id")


@query(f"""WITH {PAIRED} SELECT source1_entity_id, candidate_entity_id, round({LEV.format(a="a", b="b")}, 6) AS lev, round({JAC.format(a="a", b="b")}, 6) AS jaccard,
  {COMMON.format(a="a", b="b")}::BIGINT AS common_tokens, round({RATIO.format(a="a", b="b")}, 6) AS len_ratio, round({JW.format(a="a", b="b")}, 6) AS jaro_winkler FROM paired""")
def string_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("norm_name_1"), F.col("norm_name_2")
    out = paired(spark, sf_dir).select(
        "source1_entity_id", "candidate_entity_id", sim.levenshtein_similarity(a, b).alias("lev"), sim.token_jaccard(a, b).alias("jaccard"),
        sim.common_tokens(a, b).alias("common_tokens"), sim.length_ratio(a, b).alias("len_ratio"), sim.jaro_winkler(a, b).alias("jaro_winkler"),
    )
    return rounded(out, "lev", "jaccard", "len_ratio", "jaro_winkler")


@query(f"""WITH {PAIRED} SELECT source1_entity_id, candidate_entity_id, (ap <> '' AND bp <> '' AND ap <> bp)::INT AS pin_conflict, (ast <> '' AND bst <> '' AND ast <> bst)::INT AS street_conflict,
  ((ap <> '' AND bp <> '' AND ap <> bp) OR (ast <> '' AND bst <> '' AND ast <> bst))::INT AS number_veto, (ac = bc AND ac <> '')::INT AS country_match FROM paired""")
def number_veto(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin, street, veto = sim.number_veto(*(F.col(f"{c}_{i}") for c in ("norm_address", "pin_code", "street_number") for i in (1, 2)))
    match = sim.country_match(F.col("norm_country_1"), F.col("norm_country_2"))
    return paired(spark, sf_dir).select("source1_entity_id", "candidate_entity_id", pin.alias("pin_conflict"), street.alias("street_conflict"), veto.alias("number_veto"), match.alias("country_match"))


# Retrieval

POSTINGS = f"""{PREP},
words AS (SELECT entity_id AS id, src, ' ' || unnest(list_filter(string_split(search_text, ' '), lambda v: v <> '')) || ' ' AS w FROM prep),
sized AS (SELECT id, src, w, unnest(range(2, least(4, length(w)) + 1)) AS n FROM words),
grams AS (SELECT id, src, substr(w, i::INT, n::INT) AS gram FROM (SELECT *, unnest(range(1, length(w) - n + 2)) AS i FROM sized)),
tf AS (SELECT id, src, gram, count(*) AS tf FROM grams GROUP BY ALL),
idf AS (SELECT gram, ln((1.0 + (SELECT count(*) FROM prep)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY gram),
raw AS (SELECT id, src, gram, (1 + ln(tf)) * idf AS raw FROM tf JOIN idf USING (gram)),
postings AS (SELECT id, src, gram, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM raw)"""


def postings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    records = prep(spark, sf_dir)
    rows = retrieval.tfidf(records)
    src = records.select(F.col("entity_id").alias("id"), "src")
    named = rows.join(src, "id")
    return rows, *(named.where(c).drop("src") for c in ("src = 1", "src > 1"))


@query(f"WITH {POSTINGS} SELECT id, gram, round(weight, 6) AS weight FROM postings")
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(postings(spark, sf_dir)[0], "weight")


@query(f"""WITH {POSTINGS}, dots AS (SELECT a.id AS source1_entity_id, b.id AS candidate_entity_id, sum(a.weight * b.weight) AS score FROM postings a JOIN postings b USING (gram) WHERE a.src = 1 AND b.src > 1 GROUP BY a.id, b.id)
SELECT source1_entity_id, candidate_entity_id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY round(score, 9) DESC, candidate_entity_id) AS r FROM dots WHERE score > 0) WHERE r <= 30""")
def tfidf_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = prep(spark, sf_dir).select("entity_id", "search_text", "src")
    return rounded(retrieval.text_topk(records, records.where("src = 1"), records.where("src > 1")), "score")


def vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.concat(F.lit("v"), "vec_id").alias("id"), F.col("embedding").alias("vector"), (F.col("vec_id") % 3 == 0).alias("first"))
    return rows.where("first").drop("first"), rows.where("not first").drop("first")


@query("""WITH v AS (SELECT concat('v', vec_id) AS id, vec_id % 3 = 0 AS q, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
dots AS (SELECT a.id AS source1_entity_id, b.id AS candidate_entity_id, list_dot_product(a.e, b.e) AS score FROM v a JOIN v b ON a.q AND NOT b.q)
SELECT source1_entity_id, candidate_entity_id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY round(score, 9) DESC, candidate_entity_id) AS r FROM dots WHERE score > 0) WHERE r <= 30""")
def dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(retrieval.dense_topk(*vectors(spark, sf_dir)), "score")


@query()
def ivf_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.concat(F.lit("v"), "vec_id").alias("id"), F.col("embedding").alias("vector"), (F.col("vec_id") % 100 == 0).alias("asked"))
    return rounded(retrieval.ivf_topk(rows.where("asked").drop("asked"), rows.drop("asked")), "score")


@query(f"WITH {MERGED} SELECT source1_entity_id, candidate_entity_id, round(tfidf_score, 6) AS tfidf_score, round(sem_score, 6) AS sem_score, round(max_score, 6) AS max_score FROM merged")
def merge_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(merged(spark, sf_dir), "tfidf_score", "sem_score", "max_score")


@query(f"""WITH {MERGED}, ids AS (SELECT concat('s', s_suppkey) AS source1_entity_id FROM supplier)
SELECT i.source1_entity_id, coalesce(string_agg(m.candidate_entity_id, ',' ORDER BY round(m.max_score, 9) DESC, m.candidate_entity_id), '') AS candidate_entity_ids
FROM ids i LEFT JOIN merged m USING (source1_entity_id) GROUP BY i.source1_entity_id""")
def candidate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.candidate_lists(merged(spark, sf_dir), suppliers(spark, sf_dir))


@query(f"""WITH {MERGED} SELECT count(*) AS n_true, count(m.candidate_entity_id) AS n_found, round(count(m.candidate_entity_id)::DOUBLE / count(*), 6) AS recall
FROM (SELECT * FROM preds WHERE label = 1) t LEFT JOIN merged m USING (source1_entity_id, candidate_entity_id)""")
def blocking_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(retrieval.blocking_recall(merged(spark, sf_dir), label_truth(spark, sf_dir)), "recall")


# Features

COMPETE = """margin_sem AS (PARTITION BY candidate_entity_id ORDER BY round(sem_score, 9) DESC, source1_entity_id), margin_tfidf AS (PARTITION BY candidate_entity_id ORDER BY round(tfidf_score, 9) DESC, source1_entity_id)"""
COMPETE_COLUMNS = """round(greatest(sem_score - coalesce(lead(sem_score) OVER margin_sem, sem_score), 0), 6) AS margin_sem,
  round(greatest(tfidf_score - coalesce(lead(tfidf_score) OVER margin_tfidf, tfidf_score), 0), 6) AS margin_tfidf,
  row_number() OVER margin_sem AS rank_among_s1, count(*) OVER (PARTITION BY candidate_entity_id) AS n_competing_s1"""


@query(f"WITH {PREDS} SELECT source1_entity_id, candidate_entity_id, {COMPETE_COLUMNS} FROM preds WINDOW {COMPETE}")
def competition_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.competition_features(preds(spark, sf_dir))
    return rounded(out.select("source1_entity_id", "candidate_entity_id", "margin_sem", "margin_tfidf", "rank_among_s1", "n_competing_s1"), "margin_sem", "margin_tfidf")


TRANS = ("trans_n_candidates", "trans_mean_sem", "trans_std_sem", "trans_mean_jw", "trans_cross_source_sim")


def trans_sql(source: str) -> str:
    """CTEs trans (per S1) over a table with source1_entity_id, candidate_entity_id, name, side, sem_score, jw."""
    return f"""per AS (SELECT source1_entity_id, count(*) AS n, avg(sem_score) AS m, coalesce(stddev_samp(sem_score), 0) AS s, avg(jw) AS j FROM {source} GROUP BY source1_entity_id),
names AS (SELECT source1_entity_id, name, side, count(*) AS n FROM {source} GROUP BY ALL),
crossed AS (SELECT a.source1_entity_id, sum(a.n * b.n * ({JW.format(a="a.name", b="b.name")})) / sum(a.n * b.n) AS x FROM names a JOIN names b ON a.source1_entity_id = b.source1_entity_id AND a.side = 2 AND b.side = 3 GROUP BY a.source1_entity_id),
trans AS (SELECT p.source1_entity_id, p.n AS trans_n_candidates, round(p.m, 6) AS trans_mean_sem, round(p.s, 6) AS trans_std_sem, round(p.j, 6) AS trans_mean_jw, round(coalesce(c.x, 0), 6) AS trans_cross_source_sim FROM per p LEFT JOIN crossed c USING (source1_entity_id))"""


@query(f"""WITH {PREDS}, named AS (SELECT source1_entity_id, candidate_entity_id, sem_score, jaro_winkler_name AS jw, {norm("p_name")} AS name, CASE WHEN part_key % 2 = 1 THEN 2 ELSE 3 END AS side FROM preds JOIN part ON p_partkey = part_key),
{trans_sql("named")} SELECT n.source1_entity_id, n.candidate_entity_id, {", ".join(f"t.{c}" for c in TRANS)} FROM named n JOIN trans t USING (source1_entity_id)""")
def transitivity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("part_key"), tx.normalise(F.col("p_name")).alias("cand_norm_name"))
    named = preds(spark, sf_dir).join(part, "part_key")
    ids = lambda odd: part.where(F.col("part_key") % 2 == odd).select(F.concat(F.lit("p"), "part_key").alias("entity_id"))
    out = features.transitivity_features(named, ids(1), ids(0), max_pairs=None)
    return rounded(out.select("source1_entity_id", "candidate_entity_id", *TRANS), *TRANS[1:])


@query(f"""WITH {PREP}, cands AS ({fx.CANDIDATES}), paired AS (
  SELECT c.*, x.norm_name AS a, y.norm_name AS b, x.norm_address AS aa, y.norm_address AS ba, x.search_text AS sa, y.search_text AS sb, x.norm_country AS ac, y.norm_country AS bc,
    x.pin_code AS ap, y.pin_code AS bp, x.street_number AS ast, y.street_number AS bst, y.norm_name AS name, y.src AS side
  FROM cands c JOIN prep x ON x.entity_id = c.source1_entity_id JOIN prep y ON y.entity_id = c.candidate_entity_id),
jws AS (SELECT *, {JW.format(a="a", b="b")} AS jw FROM paired), {trans_sql("jws")}
SELECT source1_entity_id, candidate_entity_id, round(tfidf_score, 6) AS tfidf_score, round(sem_score, 6) AS sem_score, round(jw, 6) AS jaro_winkler_name, round({JW.format(a="aa", b="ba")}, 6) AS jaro_winkler_addr,
  round({LEV.format(a="a", b="b")}, 6) AS lev_norm_name, round({LEV.format(a="aa", b="ba")}, 6) AS lev_norm_addr, round({LEV.format(a="sa", b="sb")}, 6) AS lev_norm_search,
  round({JAC.format(a="a", b="b")}, 6) AS jaccard_name, round({JAC.format(a="aa", b="ba")}, 6) AS jaccard_addr, round({JAC.format(a="sa", b="sb")}, 6) AS jaccard_search,
  (ap <> '' AND bp <> '' AND ap <> bp)::INT AS pin_conflict, (ast <> '' AND bst <> '' AND ast <> bst)::INT AS street_conflict, ((ap <> '' AND bp <> '' AND ap <> bp) OR (ast <> '' AND bst <> '' AND ast <> bst))::INT AS number_veto,
  {COMPETE_COLUMNS}, {", ".join(TRANS)}, {COMMON.format(a="a", b="b")}::BIGINT AS common_token_count, round({RATIO.format(a="a", b="b")}, 6) AS name_len_ratio, round({RATIO.format(a="aa", b="ba")}, 6) AS addr_len_ratio,
  (ac = bc AND ac <> '')::INT AS country_match
FROM jws JOIN trans USING (source1_entity_id) WINDOW {COMPETE}""")
def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s2, s3 = sides(prep(spark, sf_dir))
    out = features.pair_features(fx.view(spark, sf_dir, fx.CANDIDATES), s1, s2, s3, max_pairs=None)
    return rounded(out, *[c for c, t in out.dtypes if t == "double"])


@query(f"WITH cands AS ({fx.CANDIDATES}), truth AS ({fx.TRUTH}) SELECT c.source1_entity_id, c.candidate_entity_id, (t.candidate_entity_id IS NOT NULL)::INT AS label FROM cands c LEFT JOIN truth t USING (source1_entity_id, candidate_entity_id)")
def attach_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.attach_labels(fx.view(spark, sf_dir, fx.CANDIDATES), fx.view(spark, sf_dir, fx.TRUTH)).select("source1_entity_id", "candidate_entity_id", "label")


FEATURE_REPORT = " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) AS rows, count(*) FILTER ({c} IS NULL OR isnan({c})) AS missing, count(*) FILTER (isinf({c})) AS infinite FROM preds" for c in ("tfidf_score", "sem_score", "jaro_winkler_name"))


@query(f"WITH {PREDS} {FEATURE_REPORT}")
def feature_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_report(features.clean_features(preds(spark, sf_dir)))


# Metrics

F_LABEL = "CASE WHEN tp = 0 THEN CASE WHEN tp + fn = 0 THEN 1 ELSE 0 END ELSE 1.25 * tp / (1.25 * tp + 0.25 * fn + fp) END"


@query(f"""WITH {PREDS}, c AS (SELECT source1_entity_id, count(*) FILTER (cal_prob >= 0.5 AND label = 1) AS tp, count(*) FILTER (cal_prob >= 0.5 AND label = 0) AS fp, count(*) FILTER (cal_prob < 0.5 AND label = 1) AS fn FROM preds GROUP BY source1_entity_id)
SELECT round(avg({F_LABEL}), 6) AS macro_f FROM c""")
def macro_f_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.macro_f(preds(spark, sf_dir), 0.5), "macro_f")


THRESHOLDS = f"""{PREDS}, steps AS (SELECT i + 1 AS step, 0.01::DOUBLE + 0.98::DOUBLE * i / 49 AS threshold FROM range(50) t(i)),
c AS (SELECT step, threshold, source1_entity_id, count(*) FILTER (cal_prob >= threshold AND label = 1) AS tp, count(*) FILTER (cal_prob >= threshold AND label = 0) AS fp, count(*) FILTER (cal_prob < threshold AND label = 1) AS fn FROM preds, steps GROUP BY ALL),
scan AS (SELECT step, threshold, avg({F_LABEL}) AS macro_f FROM c GROUP BY ALL)"""


@query(f"WITH {THRESHOLDS} SELECT step, round(threshold, 6) AS threshold, round(macro_f, 6) AS macro_f FROM scan")
def threshold_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.threshold_scan(preds(spark, sf_dir)), "threshold", "macro_f")


@query(f"WITH {THRESHOLDS} SELECT round(threshold, 6) AS threshold, round(macro_f, 6) AS macro_f FROM scan ORDER BY round(scan.macro_f, 12) DESC, step LIMIT 1")
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.best_threshold(preds(spark, sf_dir)), "threshold", "macro_f")


@query(f"""WITH {PREDS}, s AS (SELECT round(cal_prob, 9) AS s, count(*) AS n, sum(label) AS pos FROM preds GROUP BY 1), r AS (SELECT pos, n, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS seen FROM s)
SELECT round(sum(pos * tp / seen) / sum(pos), 6) AS average_precision, round(sum((n - pos) * (tp - pos / 2)) / (sum(pos) * sum(n - pos)), 6) AS roc_auc FROM r""")
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.average_precision(preds(spark, sf_dir)), "average_precision", "roc_auc")


@query(f"WITH {PREDS} SELECT s AS share, round(v, 6) AS value FROM (SELECT unnest([0.0, 0.25, 0.5, 0.75, 0.9, 1.0])::DOUBLE AS s, unnest(quantile_cont(cal_prob, [0.0, 0.25, 0.5, 0.75, 0.9, 1.0])) AS v FROM preds)")
def score_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.quantiles(preds(spark, sf_dir), "cal_prob"), "value")


EVALUATED = f"""{LISTS}, predicted AS (SELECT s.source1_entity_id, s.candidate_entity_id FROM scan s JOIN chosen c ON c.source1_entity_id = s.source1_entity_id AND s.k <= c.best_k),
truth AS (SELECT source1_entity_id, candidate_entity_id FROM preds WHERE label = 1),
both_ AS (SELECT source1_entity_id, count(*) FILTER (p AND t) AS tp, count(*) FILTER (p AND t IS NULL) AS fp, count(*) FILTER (p IS NULL AND t) AS fn
  FROM (SELECT *, true AS p FROM predicted) a FULL JOIN (SELECT *, true AS t FROM truth) b USING (source1_entity_id, candidate_entity_id) GROUP BY source1_entity_id),
each AS (SELECT source1_entity_id, coalesce(tp, 0)::BIGINT AS tp, coalesce(fp, 0)::BIGINT AS fp, coalesce(fn, 0)::BIGINT AS fn FROM ids LEFT JOIN both_ USING (source1_entity_id)),
scored AS (SELECT *, CASE WHEN tp = 0 THEN CASE WHEN fp + fn = 0 THEN 1 ELSE 0 END ELSE 1.25 * tp / (1.25 * tp + 0.25 * fn + fp) END AS f FROM each)"""


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.optimise_matches(decisions.resolve_constraints(preds(spark, sf_dir)), suppliers(spark, sf_dir))


@query(f"WITH {EVALUATED} SELECT source1_entity_id, tp, fp, fn, round(f, 6) AS f FROM scored")
def evaluate_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.evaluate(matched(spark, sf_dir), label_truth(spark, sf_dir)), "f")


@query(f"""WITH {EVALUATED} SELECT count(*) AS n_s1, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, round(avg(f), 6) AS macro_f,
  round(sum(tp) / greatest(sum(tp) + sum(fp), 1), 6) AS precision, round(sum(tp) / greatest(sum(tp) + sum(fn), 1), 6) AS recall FROM scored""")
def evaluation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.evaluation_summary(matched(spark, sf_dir), label_truth(spark, sf_dir)), "macro_f", "precision", "recall")


# Decisions


@query(f"WITH {RESOLVED} SELECT source1_entity_id, candidate_entity_id, round(cal_prob, 6) AS cal_prob FROM resolved")
def resolve_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(decisions.resolve_constraints(preds(spark, sf_dir)).select("source1_entity_id", "candidate_entity_id", "cal_prob"), "cal_prob")


@query(f"WITH {PREDS}, c AS (SELECT candidate_entity_id, count(*) AS n, count(DISTINCT source1_entity_id) > 1 AS c FROM preds GROUP BY 1) SELECT sum(n)::BIGINT AS n_pairs, count(*) AS n_candidates, count(*) FILTER (c) AS n_contested FROM c")
def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.constraint_report(preds(spark, sf_dir))


@query(f"WITH {SCAN} SELECT source1_entity_id, candidate_entity_id, round(prob, 6) AS prob, k, round(top_sum, 6) AS top_sum, round(total, 6) AS total, round(score, 6) AS score FROM scan")
def expected_f_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(decisions.expected_f_scan(decisions.resolve_constraints(preds(spark, sf_dir))), "prob", "top_sum", "total", "score")


@query(f"WITH {LISTS} SELECT source1_entity_id, matched_ids, best_k, round(best_ef05, 6) AS best_ef05 FROM lists")
def optimise_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = matched(spark, sf_dir).withColumn("matched_ids", F.array_join("matched_ids", ","))
    return rounded(out, "best_ef05")


@query(f"WITH {LISTS} SELECT source1_entity_id, matched_ids FROM lists")
def match_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.match_lists(matched(spark, sf_dir))


@query(f"WITH {CHOSEN} SELECT best_k, count(*) AS n_s1, round(avg(best_ef05), 6) AS mean_ef05 FROM chosen GROUP BY best_k")
def k_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(decisions.k_distribution(matched(spark, sf_dir)), "mean_ef05")


# Checks of output tables

PARSED = f"""{OUT},
cand AS (SELECT source1_entity_id, trim(unnest(string_split(candidate_entity_ids, ','))) AS id FROM outputs),
mat AS (SELECT source1_entity_id, trim(unnest(string_split(matched_ids, ','))) AS id FROM outputs WHERE matched_ids <> '')"""


def outputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    out = fx.view(spark, sf_dir, fx.OUTPUTS)
    return out.select("source1_entity_id", "candidate_entity_ids"), out.select("source1_entity_id", "matched_ids"), fx.view(spark, sf_dir, fx.OUTPUT_IDS)


@query(f"""WITH {OUT}, h AS (SELECT source1_entity_id, count(*) AS n FROM outputs GROUP BY 1)
SELECT coalesce(source1_entity_id, entity_id) AS source1_entity_id, CASE WHEN n IS NULL THEN 'missing' WHEN entity_id IS NULL THEN 'extra' ELSE 'duplicate' END AS problem
FROM h FULL JOIN out_ids ON entity_id = source1_entity_id WHERE n IS NULL OR entity_id IS NULL OR n > 1""")
def coverage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, m, ids = outputs(spark, sf_dir)
    return validation.coverage(m, ids)


@query(f"WITH {PARSED} SELECT DISTINCT source1_entity_id, id AS candidate_entity_id FROM mat m WHERE NOT EXISTS (SELECT 1 FROM cand c WHERE c.source1_entity_id = m.source1_entity_id AND c.id = m.id)")
def subset_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, m, _ = outputs(spark, sf_dir)
    return validation.outside_candidates(m, c)


@query(f"WITH {OUT}, l AS (SELECT source1_entity_id, list_transform(string_split(matched_ids, ','), lambda x: trim(x)) AS i FROM outputs WHERE matched_ids <> '') SELECT source1_entity_id, (len(i) - len(list_distinct(i)))::BIGINT AS n_repeated FROM l WHERE len(i) > len(list_distinct(i))")
def duplicate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.repeated_ids(outputs(spark, sf_dir)[1], "matched_ids")


@query(f"WITH {PARSED} SELECT id AS candidate_entity_id, count(DISTINCT source1_entity_id) AS n_owners, count(DISTINCT source1_entity_id) - 1 AS n_violations FROM mat GROUP BY id HAVING count(DISTINCT source1_entity_id) > 1")
def owner_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.shared_ids(outputs(spark, sf_dir)[1])


@query(f"WITH {OUT} SELECT source1_entity_id FROM outputs WHERE matched_ids <> '' AND (regexp_matches(matched_ids, '[\\[\\]''\"]') OR len(list_filter(string_split(matched_ids, ','), lambda x: x <> trim(x))) > 0)")
def format_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.bad_format(outputs(spark, sf_dir)[1], "matched_ids")


@query()
def validate_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate(*outputs(spark, sf_dir))


@query(f"""WITH {OUT}, m AS (SELECT len(list_filter(string_split(matched_ids, ','), lambda x: trim(x) <> '')) AS n FROM outputs), c AS (SELECT len(string_split(candidate_entity_ids, ',')) AS n FROM outputs),
u AS (SELECT count(DISTINCT x) AS n FROM (SELECT trim(unnest(string_split(matched_ids, ','))) AS x FROM outputs) WHERE x <> '')
SELECT count(*) AS n_s1, count(*) FILTER (m.n > 0) AS n_matched_s1, count(*) FILTER (m.n = 0) AS n_singletons, sum(m.n)::BIGINT AS n_matches,
  min(m.n)::DOUBLE AS matches_min, quantile_cont(m.n, 0.25)::DOUBLE AS matches_p25, quantile_cont(m.n, 0.5)::DOUBLE AS matches_median, quantile_cont(m.n, 0.75)::DOUBLE AS matches_p75, quantile_cont(m.n, 0.9)::DOUBLE AS matches_p90, max(m.n)::DOUBLE AS matches_max,
  (SELECT avg(n) FROM c) AS candidates_mean, (SELECT quantile_cont(n, 0.5)::DOUBLE FROM c) AS candidates_median, (SELECT max(n)::BIGINT FROM c) AS candidates_max, (SELECT count(*) FILTER (n = 0) FROM c) AS n_without_candidates, (SELECT n FROM u) AS n_unique_matched FROM m""")
def submission_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.submission_summary(*outputs(spark, sf_dir)[:2])


# Model


@query()
def group_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.group_folds(preds(spark, sf_dir)).groupBy("fold").agg(F.countDistinct("source1_entity_id").alias("n_s1"), F.count("*").alias("n_pairs"))


@query(f"""WITH {PREDS}, g AS (SELECT sem_score AS x, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS y FROM preds GROUP BY 1),
o AS (SELECT x, row_number() OVER (ORDER BY x) AS i, sum(n) OVER (ORDER BY x) AS cn, sum(y) OVER (ORDER BY x) AS cy, n, y FROM g),
means AS (SELECT a.i AS a, b.i AS b, (b.cy - a.cy + a.y) / (b.cn - a.cn + a.n) AS m FROM o a JOIN o b ON a.i <= b.i),
low AS (SELECT a, b AS i, min(m) OVER (PARTITION BY a ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS m FROM means),
fitted AS (SELECT i, max(m) AS v FROM low GROUP BY i)
SELECT p.source1_entity_id, p.candidate_entity_id, round(f.v, 6) AS cal_prob FROM preds p JOIN o ON o.x = p.sem_score JOIN fitted f USING (i)""")
def isotonic_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = preds(spark, sf_dir).drop("cal_prob")
    out = model.calibrated(model.calibrator(rows, "sem_score"), rows, "sem_score")
    return rounded(out.select("source1_entity_id", "candidate_entity_id", "cal_prob"), "cal_prob")


@query()
def gbt_out_of_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.competition_features(preds(spark, sf_dir))
    return rounded(model.fold_metrics(model.out_of_fold(rows)), "mean_score")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions to one owner for each candidate to the match list with the best expected F-beta."""
    return optimise_matches(spark, sf_dir)
