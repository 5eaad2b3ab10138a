"""Views of the star-schema tables that stand for entity-resolution inputs.

Each is one SQL text that Spark and DuckDB both run, over whole tables: every part is a record of one of three
sources, every supplier-part pair of lineitem a prediction, every supplier a row of the output tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Source 1 spells names out, source 2 shouts, source 3 cuts the last word to four letters; every seventh address has no postal code.
RECORDS = """
SELECT concat('p', p_partkey) AS entity_id, 1 + p_partkey % 3 AS src,
  CASE p_partkey % 3 WHEN 0 THEN concat_ws(' ', p_name, p_brand, p_type) WHEN 1 THEN upper(concat_ws(' ', p_name, p_brand, p_type))
    ELSE concat_ws(' ', p_name, p_brand, left(p_type, 4)) END AS business_name,
  concat(p_size, ' ', p_name, ' street', CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat(' ', 10000 + p_partkey % 50) END) AS business_address,
  substr('USDEFRESGB', 1 + 2 * (p_partkey % 5), 2) AS country, p_partkey, p_name, p_brand, p_type
FROM part
"""

#: A part of source 2 or 3 belongs to the first part of source 1 with the same name, brand and type.
TRUTH = f"""
SELECT min(a.entity_id) AS source1_entity_id, b.entity_id AS candidate_entity_id
FROM ({RECORDS}) a JOIN ({RECORDS}) b ON a.src = 1 AND b.src > 1 AND a.p_name = b.p_name AND a.p_brand = b.p_brand AND a.p_type = b.p_type
GROUP BY b.entity_id
"""

#: Pairs of parts with the same name and brand, with made-up retrieval scores.
CANDIDATES = f"""
SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id,
  CAST((a.p_partkey + b.p_partkey) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS tfidf_score, CAST((a.p_partkey * 7 + b.p_partkey) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS sem_score
FROM ({RECORDS}) a JOIN ({RECORDS}) b ON a.src = 1 AND b.src > 1 AND a.p_name = b.p_name AND a.p_brand = b.p_brand
"""

PREDICTIONS = """
SELECT source1_entity_id, candidate_entity_id, part_key, x * x * x AS cal_prob, x AS sem_score, t AS tfidf_score, x AS jaro_winkler_name, label
FROM (
  SELECT concat('s', l_suppkey) AS source1_entity_id, concat('p', l_partkey) AS candidate_entity_id, l_partkey AS part_key,
    CAST(CAST(floor(max(l_extendedprice)) AS BIGINT) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS x, CAST(max(l_tax) AS DOUBLE) * CAST(10 AS DOUBLE) AS t,
    CASE WHEN l_partkey % 7 = l_suppkey % 7 THEN 1 ELSE 0 END AS label
  FROM lineitem GROUP BY l_suppkey, l_partkey
) p
"""

#: Output tables with every kind of fault.
OUTPUTS = """
SELECT concat('s', s_suppkey) AS source1_entity_id, concat('p', s_suppkey, ',p', s_suppkey + 1, ',p', s_suppkey + 2) AS candidate_entity_ids,
  CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN concat('p', s_suppkey, ',p', s_suppkey) WHEN 2 THEN concat('p', s_suppkey + 1, ' ,p', s_suppkey + 9)
    WHEN 3 THEN concat('[p', s_suppkey, ']') ELSE concat('p', s_suppkey, ',p', s_suppkey + 1) END AS matched_ids
FROM (SELECT s_suppkey FROM supplier UNION ALL SELECT s_suppkey * 50 FROM supplier WHERE s_suppkey < 3) s
"""
OUTPUT_IDS = "SELECT concat('s', s_suppkey + 1) AS entity_id FROM supplier"

TABLES = ("part", "lineitem", "supplier")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A fixture's DataFrame; tables are bound by name for this statement only."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"FROM {t}" in sql}
    for t in used:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(sql, **used)
