"""Queries over word rules against their SQL on texts whose accented letters stand beside the words."""

import duckdb
import pytest

from attestra.catalog import ORACLES, QUERIES
from tools_check import digest

TEXTS = ("ciónad y lifespan", "ciómTOR und lifespan", "ſasp lifespan", "éQT lenta", "synergé", "ña cancer, éstatin", "warningé", "éantiaging cancer", "toxicé fatal", "Kidney saſp", "plain words", "combined withé cisplatin", "lıfespan")


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    at = tmp_path_factory.mktemp("odd")
    listed = ", ".join("'" + t + "'" for t in TEXTS)
    duckdb.sql(f"SELECT range AS doc_id, [{listed}][range % {len(TEXTS)} + 1] AS text, 'en' AS lang, 'src' || range % 3 AS source, 1 AS n_chars FROM range(2000)").write_parquet(f"{at}/documents.parquet")
    return str(at)


@pytest.mark.parametrize("name", ["topic_labels_longevity", "topic_labels_risk", "relevance_overrides", "export_filters", "union_axes_counts"])
def test_same_rows_as_sql(spark, odd, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{odd}/documents.parquet'")
    rel = con.execute(ORACLES[name])
    df = QUERIES[name](spark, odd)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest([d[0] for d in rel.description], rel.fetchall())


@pytest.mark.parametrize("name", ["relevance_overrides", "export_filters", "union_axes_counts"])
def test_patterns_run_once_for_a_row(spark, odd, name):
    plan = QUERIES[name](spark, odd)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("chronological aging") == 2  # of the patterns "direct" and "aging_context"
    assert plan.count("Relation") == 1
