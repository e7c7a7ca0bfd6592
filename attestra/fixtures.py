"""Views of the driver tables in the shape of the library's inputs, for queries, tests and the bench.

Each view exists twice: as a DataFrame and as the DuckDB common table expression of the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.functions.columns import lit_array

# Tag names dealt out to the driver documents; the last one is unknown to the tag map on purpose.
FIXTURE_TAGS = (
    "Causal", "Correlational", "Comparative", "Mechanistic", "Benchmark", "Measurement", "Methodological", "Background",
    "Definitional", "Observational", "GapStatement", "Hypothesis", "NoveltyAssertion", "Synthesis", "Performance",
    "FutureWork", "Roadmap", "ImpactPotential", "Hedge", "Interpretive", "SourceAttribution", "NotInMap",
)

_CLAIM_COLUMNS = """doc_id AS claim_id, source AS doc_name, doc_id AS chunk_id, text AS claim, text AS chunk_text,
  CASE doc_id % 5 WHEN 0 THEN 'Fact' WHEN 1 THEN 'Assertion' WHEN 2 THEN 'Fact' WHEN 3 THEN 'Roadmap' ELSE 'None' END AS claim_type,
  CASE doc_id % 4 WHEN 0 THEN 'supported' WHEN 1 THEN 'supported' WHEN 2 THEN 'unsupported' ELSE 'insufficient_info' END AS verdict,
  CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST((doc_id * 37) % 101 AS DOUBLE) / 100 END AS relevancy_score,
  CASE doc_id % 6 WHEN 0 THEN 'abstract' WHEN 1 THEN 'method' WHEN 2 THEN 'result' WHEN 3 THEN 'discussion' ELSE 'other' END AS semantic_category,
  CASE doc_id % 7 WHEN 0 THEN 'Key Messages' WHEN 1 THEN 'Figure 2' WHEN 2 THEN 'Materials' WHEN 3 THEN 'Conclusion' ELSE 'Findings' END AS section_heading,
  CASE doc_id % 9 WHEN 0 THEN 'strong' WHEN 1 THEN 'moderate' WHEN 2 THEN 'weak' WHEN 3 THEN 'unverifiable' WHEN 4 THEN 'unreferenced' WHEN 5 THEN 'unsupported' WHEN 6 THEN 'pending' WHEN 7 THEN 'self_reported' ELSE 'self_reported_method' END AS evidence_grade"""

_FINDINGS = """SELECT conv_id * 100 + turn AS finding_id, conv_id AS doc_id, conv_id * 100 + turn AS seq,
  CASE turn % 3 WHEN 0 THEN 'team_credibility' WHEN 1 THEN 'financial_integrity' ELSE 'real_world_traction' END AS dimension,
  CASE (conv_id + turn) % 4 WHEN 0 THEN 'red_flag' WHEN 1 THEN 'concern' WHEN 2 THEN 'info' ELSE 'bogus' END AS severity,
  text AS observation FROM {conversations}"""

_LINES = """SELECT doc_id AS line_id, text, source AS source_path, lang,
  CASE doc_id % 7 WHEN 0 THEN 'onchain_fact' WHEN 1 THEN 'pdf' WHEN 2 THEN 'text_doc' WHEN 3 THEN 'video_transcript' WHEN 4 THEN 'crawl_md' WHEN 5 THEN 'image_caption' ELSE 'unknown_kind' END AS source_kind,
  CASE doc_id % 5 WHEN 0 THEN 'claim' WHEN 1 THEN 'feature' WHEN 2 THEN 'mission' WHEN 3 THEN 'fact' ELSE 'other' END AS line_type,
  CASE lang WHEN 'en' THEN 'mission_clarity' WHEN 'fr' THEN 'team_credibility' WHEN 'de' THEN 'scientific_grounding' ELSE 'execution_competence' END AS category,
  CASE doc_id % 6 WHEN 0 THEN 'valid' WHEN 1 THEN 'positive' WHEN 2 THEN 'invalid' WHEN 3 THEN 'negative' WHEN 4 THEN 'neutral' ELSE 'inconclusive' END AS verdict
  FROM {documents}"""

_LEDGER = """SELECT CASE page_id % 3 WHEN 0 THEN 'researchhub' WHEN 1 THEN 'molecule' ELSE 'pumpScience' END AS section,
  concat('k', CAST(page_id % 40 AS VARCHAR(12))) AS entry_key, page_id % 5 = 0 AS reviewed FROM {pages}"""

_WORKS = """SELECT vec_id AS work_id, vec_id % 50 AS doc_id, concat('term', CAST(vec_id % 7 AS VARCHAR(12))) AS search_term,
  concat('W', CAST(vec_id % 300 AS VARCHAR(12))) AS openalex_id, CAST((vec_id * 31) % 100 AS DOUBLE) / 100 AS similarity, embedding
  FROM {embeddings}"""

_RUN_LOG = """SELECT event_id, ts, CAST(user_id AS VARCHAR(12)) AS run_id,
  CASE event_type WHEN 'signup' THEN 'Step 1 — Crawl' WHEN 'view' THEN 'Step 2 — review' WHEN 'click' THEN 'Step 3 — review' WHEN 'purchase' THEN 'done' ELSE 'noise line' END AS line
  FROM {events}"""

_SQL = {
    "findings": (_FINDINGS, "conversations"),
    "lines": (_LINES, "documents"),
    "ledger_prev": (_LEDGER, "pages"),
    "works": (_WORKS, "embeddings"),
    "run_log": (_RUN_LOG, "events"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in ("documents", "pages") else df


def spread(df: DataFrame) -> DataFrame:
    """Long texts over all cores when the scan has fewer splits than cores (one small file); a real data set stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with a tags array and its three single-element classification columns."""
    docs = table(spark, sf_dir, "documents")
    names = lit_array(FIXTURE_TAGS)

    def slot(n: int):
        return F.element_at(names, ((F.col("doc_id") * n * 7 + n) % 22 + 1).cast("int"))

    tags = F.when(F.col("doc_id") % 13 == 0, F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.array(slot(1), slot(2), slot(3))))
    base = docs.selectExpr("doc_id", "source", "text").select("*", tags.alias("tags"))
    return base.selectExpr(*_split_select(_CLAIM_COLUMNS), "tags")


def _split_select(block: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in block:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(cur.strip())
            cur = ""
        else:
            cur += ch
    return out + [cur.strip()]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "claims":
        return claims(spark, sf_dir)
    sql, source = _SQL[name]
    return spark.sql(sql, **{source: table(spark, sf_dir, source)})


_DUCK_TAGS = "[" + ", ".join(f"'{t}'" for t in FIXTURE_TAGS) + "]"


def _duck_slot(n: int) -> str:
    return f"{_DUCK_TAGS}[(doc_id * {n} * 7 + {n}) % 22 + 1]"


def cte(*names: str) -> str:
    """DuckDB WITH clause of the named views (no trailing comma)."""
    parts = []
    for n in names:
        if n == "claims":
            tags = (f"CASE WHEN doc_id % 13 = 0 THEN CAST([] AS VARCHAR[]) ELSE "
                    f"list_distinct([{_duck_slot(1)}, {_duck_slot(2)}, {_duck_slot(3)}]) END AS tags")
            parts.append(f"claims AS (SELECT {_CLAIM_COLUMNS}, {tags} FROM documents)")
        else:
            sql, source = _SQL[n]
            parts.append(f"{n} AS ({sql.format(**{source: source})})")
    return "WITH " + ",\n".join(parts)
