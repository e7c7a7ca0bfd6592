"""Queries that moved a row a word: the same results from rows that stay whole, and nothing exploded on its way to an exchange."""

import duckdb

from attestra.catalog import QUERIES
from test_query_edges import same


def exploded(spark, at, name):
    """Generates below the exchanges of the plan."""
    plan = QUERIES[name](spark, str(at))._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Generate")


def docs(rows):
    """documents from (doc_id, text SQL)."""
    return " UNION ALL ".join(f"SELECT {i}::BIGINT AS doc_id, {t} AS text, 'en' AS lang, 'a' AS source, 1 AS n_chars" for i, t in rows)


def test_abstracts_of_repeated_ids_and_words(spark, tmp_path):
    rows = [(1, "'b a b  a c'"), (1, "'a second text of one id'"), (2, "'one'"), (3, "' x  x '"), (4, "chr(233) || ' e ' || chr(233)")]
    assert same(spark, tmp_path, "rebuild_abstract", {"documents": docs(rows)})
    assert exploded(spark, tmp_path, "rebuild_abstract") == 0


def test_cosines_of_neighbours(spark, tmp_path):
    rows = [(1, "'one two two three'"), (2, "'two two two four'"), (2, "'two five'"), (3, "'a b'"), (4, "NULL"), (5, "'five five'"), (6, "'FIVE six'")]
    assert same(spark, tmp_path, "cosine_counts", {"documents": docs(rows)})
    assert exploded(spark, tmp_path, "cosine_counts") == 0


def thinned(spark, at, name):
    """Whether exploded rows pass the bit table before they move."""
    return "getbit" in QUERIES[name](spark, str(at))._jdf.queryExecution().optimizedPlan().toString().lower()


def test_rows_without_a_partner_do_not_move(spark):
    from attestra.operators.joins import maybe_met
    rows, named = spark.range(-5000, 5000).selectExpr("xxhash64(id) AS k", "id"), spark.range(0, 5000, 100).selectExpr("xxhash64(id) AS k")
    got = {r.id for r in maybe_met(rows.unionByName(spark.sql("SELECT cast(null AS bigint) AS k, 7L AS id")), named, "k").collect()}
    assert set(range(0, 5000, 100)) <= got and len(got) < 60
    assert maybe_met(rows, named.limit(0), "k").count() == 0


def test_borrowed_citations_meet_on_thinned_seeds(spark, tmp_path):
    said = "the same long sentence is said by one chunk and by another one of the document"
    rows = [(1, f"'{said}'"), (5, f"'before {said} after (3, 4)'"), (9, f"'{said.upper()} (12)'"), (12, "'nothing of that kind at all is said here (5)'"), (20, f"'{'x' * 40}'"), (22, f"'{'x' * 50} (8)'")]
    assert same(spark, tmp_path, "borrow_citations", {"documents": docs(rows)})
    assert thinned(spark, tmp_path, "borrow_citations")


def test_borrowed_citations_move_the_texts_of_candidates_alone(spark, tmp_path):
    """Texts that no claim can lie in stay where they are, also in a document with a claim of one long word."""
    said = "the same long sentence is said by one chunk and by another one of the document"
    noise = "(SELECT string_agg(substr(md5('{i} ' || k), 1, 9), ' ') FROM range(9000) AS r(k))"
    apart = [(100 + i, f"{noise.format(i=i)} || ' (3)'") for i in range(24)] + [(124, "'short (3)'")]  # each one's next cites, so their claims ask for nothing
    rows = [(1, f"'{said}'"), (5, f"'before {said} after (3, 4)'"), (20, f"'{'x' * 40}'"), (22, f"'{'x' * 50} (8)'"), *apart]
    found = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True)
    moved = lambda: sum(e.totalShuffleWrite() for e in map(found().apply, range(found().size())))
    duckdb.sql(docs(rows)).write_parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{tmp_path}/documents.parquet").repartition(8).write.parquet(f"{tmp_path}/spread/documents.parquet")  # as many files as cores: the scan moves nothing
    before = moved()
    got = {r.claim_id: r.numbers for r in QUERIES["borrow_citations"](spark, f"{tmp_path}/spread").collect()}
    assert (got[1], got[20]) == ("3,4", "8") and moved() - before < 500_000  # the noise is 2 MB


def test_labels_with_aliases_of_any_length(spark, tmp_path):
    rows = [(10, "'xxalpha beta gamma'"), (11, "'the ALPHA of it'"), (12, "'alph'"), (20, "'qqb       '"), (21, "'ab'"), (30, "'zzxy      and'"), (31, "'a yxyx'"), (33, "NULL")]
    assert same(spark, tmp_path, "label_matches", {"documents": docs(rows)})
    assert thinned(spark, tmp_path, "label_matches")


def test_first_mentions(spark, tmp_path):
    rows = docs([(1, "'a thing of much nder'"), (2, "'then Thing again and mentre'"), (3, "'no name'")]) + " UNION ALL SELECT 4, 'one THING more, eaux', 'fr', 'a', 1 UNION ALL SELECT 5, 'lich osas ciado', 'de', 'a', 1"
    assert same(spark, tmp_path, "name_mentions", {"documents": rows})
    assert thinned(spark, tmp_path, "name_mentions")


def test_sections_are_cut_once(spark, tmp_path):
    long = "'# H' || chr(10) || repeat('a long section text ', 8)"
    duckdb.sql(docs([(1, long), (2, long), (3, f"{long} || chr(10) || '## Own' || chr(10) || repeat('another section ', 9)")])).write_parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.kept, r.dropped) for r in QUERIES["dedupe_sections"](spark, str(tmp_path)).collect()}
    assert got[1][0] > 0 and got[2][0] == 0 and got[3][0] == 1
    assert exploded(spark, tmp_path, "dedupe_sections") == 0


def test_texts_cut_twice_are_cut_once(spark):
    from attestra.functions.text import truncate
    texts = [" " + "word " * n + "\n " * k + "x" * j for n in (0, 1, 4, 5, 9) for k in (0, 2) for j in (0, 1, 3, 8)] + ["a" * n + " " * 3 + "b" for n in range(12, 26)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for size in (20, 19, 8, 1):
        assert df.filter(~truncate(truncate("t", 21), size).eqNullSafe(truncate("t", size))).isEmpty()


def test_audit_inputs_are_made_once(spark):
    plan = QUERIES["fit_audit"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "documents" not in plan and "Relation" not in plan


def test_assay_cells_by_place(spark):
    from pyspark.sql import functions as F

    from attestra.sources.material import columnar_cells_to_rows
    tables = [
        (1, '{"Table": {"Columns": {"Column": ["AID", "Assay Name", "Assay Type", "Assay Name"]}, "Row": [{"Cell": ["7", "", "x", "z"]}, {"Cell": ["8", "n"]}, {"Cell": 5}, 3, {"Cell": ["no", "n"]}]}}'),
        (2, '{"Table": {"Columns": {"Column": ["AssayName", "AID"]}, "Row": {"Cell": ["one", 9, "more"]}}}'),
        (3, '{"Table": {"Columns": {"Column": "AID"}, "Row": [{"Cell": ["4"]}, {"Cell": []}]}}'),
        (4, '{"Table": {"Columns": {}}}')]
    df = spark.createDataFrame(tables, "cid int, j string").select("cid", F.parse_json("j").alias("table"))
    got = sorted(tuple(r) for r in columnar_cells_to_rows(df, ["cid"]).collect())
    assert got == [(1, 0, 7, "", "x"), (1, 1, 8, "n", None), (2, 0, 9, "one", None), (3, 0, 4, "", None)]


def test_context_of_long_parts(spark, tmp_path):
    rows = [(i, f"repeat('part {i} of it ', {n})") for i, n in ((1, 400), (2, 10), (3, 260), (5, 3), (6, 500), (7, 230), (8, 1), (13, 300), (14, 9), (20, 250))]
    assert same(spark, tmp_path, "context_sections", {"documents": docs(rows)})
    plan = QUERIES["context_sections"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("substring(") > 2  # near and far parts are cut below the joins too
