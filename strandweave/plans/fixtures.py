"""Annotation tables derived from the given tables, as SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

EXONS = """
SELECT concat('chr', CAST(l_orderkey % 20 AS STRING)) AS seq_id,
       concat('g', CAST(l_orderkey AS STRING)) AS parent_id,
       concat('g', CAST(l_orderkey AS STRING), '_e', CAST(l_linenumber AS STRING)) AS feature_id,
       CAST(l_orderkey % 4 AS INT) AS file_level,
       CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE -1 END AS strand,
       s AS start_pos, s + 29 + 3 * q AS end_pos
FROM (SELECT l_orderkey, l_linenumber, q,
             CAST(FLOOR(l_orderkey / 20) AS BIGINT) * 300 + l_linenumber * 220 + pk % 60 + 1 AS s
      FROM (SELECT l_orderkey, l_linenumber, CAST(MIN(l_quantity) AS BIGINT) AS q, MAX(l_partkey) AS pk
            FROM lineitem GROUP BY l_orderkey, l_linenumber) a) b"""

EVIDENCE = """
SELECT concat('chr', CAST(l_orderkey % 20 AS STRING)) AS seq_id,
       concat('ev', CAST(l_orderkey AS STRING), '_', CAST(k AS STRING)) AS evidence_id,
       CASE k WHEN 0 THEN 'proteicEvidences' WHEN 1 THEN 'highQualityNucleicEvidences' ELSE 'otherNucleicEvidences' END AS category,
       concat('db', CAST(k AS STRING)) AS db,
       CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE -1 END AS strand,
       s AS start_pos, s + 29 + 3 * q AS end_pos
FROM (SELECT l_orderkey, k, q,
             CAST(FLOOR(l_orderkey / 20) AS BIGINT) * 300 + l_linenumber * 220 + pk % 60 + 1 + (sk % 5) * 3 - 6 AS s
      FROM (SELECT l_orderkey, l_linenumber, MIN(l_suppkey) % 3 AS k, MIN(l_suppkey) AS sk,
                   CAST(MIN(l_quantity) AS BIGINT) AS q, MAX(l_partkey) AS pk
            FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_linenumber) a) b"""

HSPS = """
SELECT concat('q', CAST(l_orderkey % 500 AS STRING)) AS query_id, CAST(800 AS BIGINT) AS query_len,
       concat('h', CAST(l_partkey % 40 AS STRING)) AS hit_id, CAST(900 AS BIGINT) AS hit_len,
       CASE WHEN l_returnflag = 'A' THEN -1 ELSE 1 END AS strand,
       l_partkey % 600 + 1 AS q_start, l_partkey % 600 + 30 + 3 * q AS q_end,
       (l_suppkey * 7) % 600 + 1 AS h_start, (l_suppkey * 7) % 600 + 30 + 3 * q - l_suppkey % 4 AS h_end,
       30 + 3 * q AS align_len, l_suppkey % 4 AS gaps, l_orderkey * 10 + l_linenumber AS ordinal,
       CAST(FLOOR((30 + 3 * q) * (60 + l_orderkey % 41) / 100) AS BIGINT) AS n_identical,
       LEAST(30 + 3 * q, CAST(FLOOR((30 + 3 * q) * (60 + l_orderkey % 41) / 100) AS BIGINT) + l_partkey % 9) AS n_positive,
       CAST(ROUND(l_extendedprice) AS BIGINT) AS bit_score,
       p_name AS hit_description
FROM (SELECT l.*, CAST(l_quantity AS BIGINT) AS q, p_name FROM lineitem l JOIN part ON p_partkey = l_partkey) a"""

CDS = """
SELECT concat('seq', CAST(l_orderkey % 200 AS STRING)) AS seq_id,
       concat('m', CAST(l_orderkey AS STRING)) AS parent_id,
       CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE -1 END AS strand,
       s AS start_pos, s + 29 + 2 * q AS end_pos
FROM (SELECT l_orderkey, q, (l_linenumber - 1) * 140 + pk % 11 + 1 AS s
      FROM (SELECT l_orderkey, l_linenumber, CAST(MIN(l_quantity) AS BIGINT) AS q, MAX(l_partkey) AS pk
            FROM lineitem GROUP BY l_orderkey, l_linenumber) a) b"""

TASK_RUNS = """
SELECT event_id AS task_id, concat('s', CAST(user_id % 50 AS STRING)) AS seq_id, user_id % 7 AS chunk_no,
       CASE WHEN event_type IN ('click', 'view') THEN 'execution' ELSE 'parsing' END AS kind,
       CASE event_type WHEN 'error' THEN 11 WHEN 'signup' THEN 12 ELSE 10 END AS status, value AS real_time
FROM events"""

_SEQUENCES = """
SELECT doc_id AS seq_no, concat('seq', CAST(doc_id AS STRING)) AS seq_id,
       CASE WHEN doc_id % 10 = 0 THEN concat(substring(raw, 1, 100), repeat('N', 20), substring(raw, 121)) ELSE raw END AS residues
FROM (SELECT doc_id, {parts} AS raw FROM documents) a"""
_PART = "translate(md5(concat(CAST(doc_id AS STRING), '_', CAST(i AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT')"
SEQUENCES = _SEQUENCES.format(parts=f"array_to_string(list_transform(range(0, 32), lambda i: {_PART}), '')")
_SPARK_SEQUENCES = _SEQUENCES.format(parts=f"array_join(transform(sequence(0, 31), i -> {_PART}), '')")

#: One gene model a gene of EXONS: its exons as ordered parts, and figures that stand in for its protein hits.
MODELS = f"""
SELECT seq_id, parent_id AS model_id, CAST(MIN(file_level) AS INT) AS file_level, MIN(strand) AS strand, MIN(start_pos) AS start_pos, MAX(end_pos) AS end_pos,
       COUNT(*) AS n_exons, SUM(end_pos - start_pos + 1) % 121 AS hit_coverage, SUM(start_pos) % 121 AS query_coverage, SUM(end_pos) % 101 AS identity
FROM ({EXONS}) e GROUP BY seq_id, parent_id"""

FIXTURES = {"fx_exons": EXONS, "fx_evidence": EVIDENCE, "fx_hsps": HSPS, "fx_cds": CDS, "fx_task_runs": TASK_RUNS, "fx_sequences": SEQUENCES, "fx_models": MODELS}


#: Rows of a given table that one task groups.
ROWS = 500_000


def shares(df: DataFrame) -> int:
    """Tasks of ``ROWS`` rows or so for a given table, by the counts in its files, so that a task's part doesn't grow with it."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table by its fx_ name, or a given one."""
    if name not in FIXTURES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = _SPARK_SEQUENCES if name == "fx_sequences" else FIXTURES[name]
    used = [t for t in ("lineitem", "part", "events", "documents") if f"FROM {t}" in text or f"JOIN {t}" in text]
    for t in used:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    given = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    if "GROUP BY l_orderkey, l_linenumber" in text:
        # Partitioned by order, lines are grouped without another shuffle.
        given["lineitem"] = given["lineitem"].repartition(shares(given["lineitem"]), "l_orderkey")
    return spark.sql(text, **given)


def with_fixtures(body: str, *names: str) -> str:
    """DuckDB SQL: ``body`` after the definitions of the fx_ tables that it names; ``body`` may begin with more of them."""
    import re

    found = names or tuple(n for n in FIXTURES if re.search(rf"\b{n}\b", body))
    head = ",\n".join(f"{n} AS ({FIXTURES[n]})" for n in found)
    body = body.strip()
    if not head:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head},\n{body[14:].strip()}"
    return f"WITH {head},\n{body[4:].strip()}" if body.upper().startswith("WITH") else f"WITH {head}\n{body}"
