"""Queries for ledgers, joins, rankings, packing and distinct picks."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestra.catalog.registry import query
from attestra.catalog.texts import LINK_CTE, links
from attestra.fixtures import claims, cte, table, view
from attestra.functions import text as T
from attestra.operators import citations as CI
from attestra.operators import joins as J
from attestra.operators import ledger as L
from attestra.operators import packing as P
from attestra.operators import ranking as K


def docs(spark, d):
    return table(spark, d, "documents")


# --- X1-X4, J-12 ------------------------------------------------------------------------------------
_NORM = "n AS (SELECT section, entry_key, bool_or(reviewed) AS reviewed FROM ledger_prev GROUP BY ALL)"


@query("ledger_normalize", cte("ledger_prev") + f", {_NORM} SELECT * FROM n")
def _(spark, d):
    return L.normalize_ledger(view(spark, d, "ledger_prev"))


_DISK = "SELECT 'molecule' AS section, 'k' || (doc_id % 60) AS entry_key, doc_id FROM documents"


@query("ledger_merge", cte("ledger_prev") + f", {_NORM} SELECT * FROM n UNION ALL SELECT DISTINCT section, entry_key, FALSE FROM ({_DISK}) x WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.section = x.section AND n.entry_key = x.entry_key)")
def _(spark, d):
    disk = docs(spark, d).select(F.lit("molecule").alias("section"), F.concat(F.lit("k"), (F.col("doc_id") % 60).cast("string")).alias("entry_key"))
    return L.merge_ledger(view(spark, d, "ledger_prev"), disk)


@query("ledger_mark", cte("ledger_prev") + f" SELECT section, entry_key, bool_or(reviewed) AS reviewed FROM (SELECT * FROM ledger_prev UNION ALL SELECT section, entry_key, TRUE FROM ({_DISK}) x WHERE doc_id % 3 = 0) GROUP BY ALL")
def _(spark, d):
    marks = docs(spark, d).filter("doc_id % 3 = 0").select(F.lit("molecule").alias("section"), F.concat(F.lit("k"), (F.col("doc_id") % 60).cast("string")).alias("entry_key"))
    return L.mark_reviewed(view(spark, d, "ledger_prev"), marks)


@query("ledger_reviewed_keys", cte("ledger_prev") + " SELECT DISTINCT section, entry_key FROM ledger_prev WHERE reviewed")
def _(spark, d):
    return L.reviewed_keys(view(spark, d, "ledger_prev"))


@query("skip_reviewed", cte("ledger_prev") + " SELECT doc_id FROM documents WHERE 'k' || (doc_id % 60) NOT IN (SELECT entry_key FROM ledger_prev WHERE reviewed AND section = 'molecule')")
def _(spark, d):
    items = docs(spark, d).select("doc_id", F.concat(F.lit("k"), (F.col("doc_id") % 60).cast("string")).alias("folder"))
    return J.skip_reviewed(items, view(spark, d, "ledger_prev"), "folder", "molecule").select("doc_id")


@query("resolve_ledger_key", """WITH p AS (SELECT source AS folder, min(CASE WHEN lang = 'en' THEN lang || source END) AS symbol FROM documents GROUP BY source), r AS (SELECT doc_id AS review_id, CASE doc_id % 4 WHEN 0 THEN 'proposal' WHEN 1 THEN 'compounds' WHEN 2 THEN 'dao' ELSE 'article' END AS route,
  CASE WHEN doc_id % 8 = 2 THEN source WHEN doc_id % 8 = 6 THEN 'en' || source WHEN doc_id % 8 = 1 THEN '' ELSE 'nm' || doc_id END AS name, CASE doc_id % 4 WHEN 0 THEN CASE WHEN doc_id % 8 = 0 THEN 'proposal_' || doc_id ELSE 'x' || doc_id END WHEN 3 THEN 'stem' || (doc_id % 30) ELSE 'dir' || doc_id END AS parent_dir FROM documents)
  SELECT review_id, route, CASE WHEN key IS NULL THEN NULL WHEN route IN ('proposal', 'article') THEN 'researchhub' WHEN route = 'compounds' THEN 'pumpScience' ELSE 'molecule' END AS section, key AS entry_key FROM (SELECT *, CASE route WHEN 'proposal' THEN CASE WHEN parent_dir LIKE 'proposal\\_%' ESCAPE '\\' THEN 'proposals/' || parent_dir || '.json' END
   WHEN 'compounds' THEN coalesce(nullif(name, ''), parent_dir) WHEN 'dao' THEN coalesce((SELECT min(folder) FROM p WHERE p.folder = r.name OR p.symbol = r.name), parent_dir) ELSE CASE WHEN CAST(substr(parent_dir, 5) AS INT) < 20 THEN 'papers/PaperRecord_' || substr(parent_dir, 5) END END AS key FROM r)""")
def _(spark, d):
    base = docs(spark, d)
    prof = base.groupBy(F.col("source").alias("folder")).agg(F.min(F.expr("CASE WHEN lang = 'en' THEN concat(lang, source) END")).alias("symbol")).withColumn("initial_symbol", F.lit(None).cast("string"))
    r = base.selectExpr("doc_id AS review_id", "CASE doc_id % 4 WHEN 0 THEN 'proposal' WHEN 1 THEN 'compounds' WHEN 2 THEN 'dao' ELSE 'article' END AS route",
                        "CASE WHEN doc_id % 8 = 2 THEN source WHEN doc_id % 8 = 6 THEN concat('en', source) WHEN doc_id % 8 = 1 THEN '' ELSE concat('nm', doc_id) END AS name",
                        "CASE doc_id % 4 WHEN 0 THEN CASE WHEN doc_id % 8 = 0 THEN concat('proposal_', doc_id) ELSE concat('x', doc_id) END WHEN 3 THEN concat('stem', doc_id % 30) ELSE concat('dir', doc_id) END AS parent_dir")
    papers = base.selectExpr("concat('stem', doc_id % 20) AS pdf_stem", "concat('PaperRecord_', doc_id % 20) AS record_name").distinct()
    return J.resolve_ledger_key(r, prof, papers)


@query("checkpoint_points", "SELECT o_orderkey, rn AS row_no FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'F') WHERE rn % 5 = 0")
def _(spark, d):
    return L.checkpoint_points(table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey"), "o_orderkey")


@query("resume_step", "SELECT o_orderkey, coalesce(min(l_linenumber) FILTER (l_returnflag = 'N'), max(l_linenumber) + 1) AS resume_at FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def _(spark, d):
    r = table(spark, d, "lineitem").join(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("step"), F.when(F.col("l_returnflag") != "N", "tx").alias("txid"))
    return L.resume_step(r, ["o_orderkey"])


@query("skip_unchanged", "WITH h AS (SELECT source, list_sort(list(DISTINCT lang || doc_id % 3)) AS a, list_sort(list(DISTINCT lang || doc_id % 3) FILTER (doc_id % 50 <> 7)) AS b FROM documents GROUP BY source) SELECT source FROM h WHERE a <> b OR source LIKE '%5'")
def _(spark, d):
    h = F.concat("lang", (F.col("doc_id") % 3).cast("string"))
    items = docs(spark, d).groupBy("source").agg(F.collect_set(h).alias("handles"))
    man = docs(spark, d).filter("doc_id % 50 <> 7").groupBy("source").agg(F.collect_set(h).alias("handles")).withColumn("status", F.when(F.col("source").like("%5"), "failed").otherwise("success"))
    return L.skip_unchanged(items, man, "source").select("source")


@query("since_last_run", "SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01' OR o_orderkey % 50 = 0")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 50 == 0, "soon").otherwise(F.col("o_orderdate").cast("string")).alias("day"))
    return L.since_last_run(o, "day", "1996-01-01 00:00:00").select("o_orderkey")


@query("follow_budget", """WITH c AS (SELECT o_custkey % 30 AS project, o_orderkey % 100 AS k, min(o_orderkey) AS seq FROM orders WHERE o_orderkey % 100 NOT IN (SELECT o_orderkey % 100 FROM orders WHERE o_orderkey < 40) GROUP BY ALL)
  SELECT project, k FROM c QUALIFY row_number() OVER (PARTITION BY project ORDER BY seq) <= 12""")
def _(spark, d):
    o = table(spark, d, "orders").selectExpr("o_custkey % 30 AS project", "o_orderkey % 100 AS k", "o_orderkey AS seq")
    early = table(spark, d, "orders").filter("o_orderkey < 40").selectExpr("o_orderkey % 100 AS k").distinct()
    done = o.join(early, "k", "left_semi").select("project", "k").distinct()
    return L.follow_budget(o, done, ["project"], "k", ["seq"]).select("project", "k")


# --- J-13, J-19, J-21, J-24 -------------------------------------------------------------------------
@query("unpulled_links", f"WITH {LINK_CTE} SELECT page_id FROM l WHERE link NOT IN (SELECT link FROM l WHERE page_id % 4 = 0)")
def _(spark, d):
    ln = links(spark, d)
    return J.unpulled_links(ln, ln.filter("page_id % 4 = 0"), url="link").select("page_id")


@query("uncrawled", "SELECT page_id FROM pages WHERE rtrim(url, '/') NOT IN (SELECT rtrim(url, '/') FROM pages WHERE page_id % 3 = 0)")
def _(spark, d):
    p = table(spark, d, "pages")
    man = p.filter("page_id % 3 < 2").select(F.concat("url", F.lit("/")).alias("url"), (F.col("page_id") % 3 == 0).alias("success"))
    return J.uncrawled(p, man).select("page_id")


@query("attach_reachability", f"WITH {LINK_CTE} SELECT page_id, CASE WHEN page_id % 14 = 2 THEN 'yes' WHEN page_id % 14 = 13 AND page_id % 4 = 1 THEN 'yes' ELSE 'no' END AS http_accessible FROM l WHERE page_id % 14 <> 2 OR page_id % 4 = 2")
def _(spark, d):
    from attestra.functions.urls import probe_url
    ln = links(spark, d).drop("http_accessible")
    probes = ln.filter("(page_id % 14 = 2 AND page_id % 4 = 2) OR (page_id % 14 = 13 AND page_id % 4 = 1)").select(probe_url("link").alias("checked_url"), F.lit("yes").alias("accessible"))
    return J.attach_reachability(ln, probes, "link").select("page_id", "http_accessible")


@query("cache_split", "WITH n AS (SELECT DISTINCT o_custkey AS k FROM orders), c AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0) SELECT k, k IN (SELECT k FROM c) AS hit FROM n")
def _(spark, d):
    hits, misses = J.cache_split(table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k")), "k")
    return hits.withColumn("hit", F.lit(True)).unionByName(misses.withColumn("hit", F.lit(False)))


@query("attach_line_meta", cte("lines") + " SELECT line_id, CASE WHEN line_id % 2 = 0 THEN line_id % 9 ELSE 1 END AS cluster_id, CASE WHEN line_id % 2 = 0 THEN 3 ELSE 1 END AS cluster_size FROM lines")
def _(spark, d):
    ln = view(spark, d, "lines")
    meta = ln.filter("line_id % 2 = 0").select("line_id", (F.col("line_id") % 9).alias("cluster_id"), F.lit(3).alias("cluster_size"), F.lit(1.0).alias("effective_weight"))
    return J.attach_line_meta(ln, meta).select("line_id", "cluster_id", "cluster_size")


@query("append_new", "SELECT doc_id FROM documents WHERE doc_id % 5 = 0 OR 'k' || (doc_id % 70) NOT IN (SELECT 'k' || (page_id % 70) FROM pages WHERE page_id % 2 = 0)")
def _(spark, d):
    rows = docs(spark, d).select("doc_id", F.expr("CASE WHEN doc_id % 5 <> 0 THEN concat('k', doc_id % 70) END").alias("key"))
    return J.append_new(rows, table(spark, d, "pages").filter("page_id % 2 = 0").selectExpr("concat('k', page_id % 70) AS key"), "key").select("doc_id")


# --- J-2..J-5, J-7, J-8, J-22, A26-A28 ---------------------------------------------------------------
def chunk_table(spark, d):
    """One chunk per document of a source; every third one cites."""
    return docs(spark, d).selectExpr("source AS doc_name", "doc_id AS chunk_id", "CASE WHEN doc_id % 3 = 0 THEN concat(text, ' Extra (', doc_id % 40 + 1, ', 7).') ELSE text END AS text",
                                     "CASE doc_id % 4 WHEN 0 THEN 'Results and data' WHEN 1 THEN 'Discussion' WHEN 2 THEN 'Timeline' ELSE 'References' END AS section_heading",
                                     "CASE WHEN doc_id % 6 = 0 THEN 'abstract' ELSE 'other' END AS semantic_category")


CHUNKS = ("chunks AS (SELECT source AS doc_name, doc_id AS chunk_id, CASE WHEN doc_id % 3 = 0 THEN concat(text, ' Extra (', doc_id % 40 + 1, ', 7).') ELSE text END AS text, "
          "CASE doc_id % 4 WHEN 0 THEN 'Results and data' WHEN 1 THEN 'Discussion' WHEN 2 THEN 'Timeline' ELSE 'References' END AS section_heading, CASE WHEN doc_id % 6 = 0 THEN 'abstract' ELSE 'other' END AS semantic_category FROM documents)")


@query("missing_chunks", "SELECT doc_id AS claim_id FROM documents WHERE doc_id % 7 = 0")
def _(spark, d):
    c = claims(spark, d)
    return CI.missing_chunks(c, chunk_table(spark, d).filter("chunk_id % 7 <> 0"), ("doc_name", "chunk_id")).select("claim_id")


@query("attach_chunk", "SELECT doc_id AS claim_id, CASE WHEN doc_id % 7 <> 0 THEN length(CASE WHEN doc_id % 3 = 0 THEN concat(text, ' Extra (', doc_id % 40 + 1, ', 7).') ELSE text END) END AS n FROM documents")
def _(spark, d):
    c = claims(spark, d).select("claim_id", "doc_name", "chunk_id")
    return CI.attach_chunk(c, chunk_table(spark, d).filter("chunk_id % 7 <> 0"), ("doc_name", "chunk_id")).select("claim_id", F.length("text").alias("n"))


def ref_tables(spark, d):
    refs = docs(spark, d).selectExpr("source AS doc_name", "cast(doc_id % 45 + 1 as int) AS ref_number", "concat('HTTPS://doi.org/10.1/W', doc_id % 45) AS doi").distinct()
    works = table(spark, d, "embeddings").filter("vec_id % 300 < 40 AND vec_id < 300").selectExpr(
        "concat('10.1/w', vec_id % 300) AS doi", "concat('T', vec_id) AS title", "CASE WHEN vec_id % 4 = 0 THEN 'no_abstract' ELSE 'ok' END AS status", "CASE WHEN vec_id % 4 <> 0 THEN repeat(concat('a', vec_id, ' '), 200) END AS abstract")
    return refs, works


_REFS = ("refs AS (SELECT DISTINCT source AS doc_name, CAST(doc_id % 45 + 1 AS INT) AS ref_number, '10.1/w' || (doc_id % 45) AS key FROM documents), "
         "works AS (SELECT '10.1/w' || (vec_id % 300) AS key, 'T' || vec_id AS title, CASE WHEN vec_id % 4 = 0 THEN 'no_abstract' ELSE 'ok' END AS status, CASE WHEN vec_id % 4 <> 0 THEN repeat('a' || vec_id || ' ', 200) END AS abstract FROM embeddings WHERE vec_id % 300 < 40 AND vec_id < 300), "
         "cited AS (SELECT DISTINCT doc_id AS claim_id, source AS doc_name, n AS ref_number FROM (SELECT doc_id, source, unnest([CAST(doc_id % 40 + 1 AS INT), 7, CAST(doc_id % 5 + 41 AS INT)]) AS n FROM documents)), "
         "rows AS (SELECT claim_id, c.ref_number, r.key IS NOT NULL AS resolved, title, status, abstract FROM cited c LEFT JOIN refs r USING (doc_name, ref_number) LEFT JOIN works w ON w.key = r.key)")


def cited(spark, d):
    return docs(spark, d).select(F.col("doc_id").alias("claim_id"), F.col("source").alias("doc_name"), F.array_distinct(F.expr("array(cast(doc_id % 40 + 1 as int), 7, cast(doc_id % 5 + 41 as int))")).alias("numbers"))


@query("citation_rows", f"WITH {_REFS} SELECT claim_id, ref_number, resolved, title, length(substr(abstract, 1, 500)) AS n FROM rows")
def _(spark, d):
    refs, works = ref_tables(spark, d)
    return CI.citation_rows(cited(spark, d), refs, works, ["claim_id"], "doc_name").select("claim_id", "ref_number", F.col("doi").isNotNull().alias("resolved"), "title", F.length("abstract").alias("n"))


@query("usable_refs", f"WITH {_REFS} SELECT claim_id, count(*) AS usable FROM rows WHERE status = 'ok' AND abstract <> '' GROUP BY claim_id")
def _(spark, d):
    refs, works = ref_tables(spark, d)
    return CI.usable_refs(CI.citation_rows(cited(spark, d), refs, works, ["claim_id"], "doc_name")).groupBy("claim_id").agg(F.count("*").alias("usable"))


@query("window_refs", f"WITH {_REFS} SELECT claim_id, ref_number, title, row_number() OVER (PARTITION BY claim_id ORDER BY ref_number) AS rank, length(substr(abstract, 1, 200)) AS n FROM rows WHERE status = 'ok' AND abstract <> '' QUALIFY rank <= 2")
def _(spark, d):
    refs, works = ref_tables(spark, d)
    return CI.window_refs(cited(spark, d), refs, works, ["claim_id"], "doc_name", 2).select("claim_id", "ref_number", "title", "rank", F.length("abstract").alias("n"))


_FOLD = "replace(lower(trim(regexp_replace({c}, '\\s+', ' ', 'g'))), 'ß', 'ss')"


@query("borrow_citations", cte("claims") + f""", {CHUNKS}, g AS (SELECT doc_name, chunk_id, {_FOLD.format(c='text')} AS t, text, unnest(regexp_extract_all(text, '\\(([^)]+)\\)', 1)) AS g FROM chunks),
  n AS (SELECT doc_name, chunk_id, t, trim(unnest(string_split(g, ','))) AS p FROM g WHERE regexp_matches(trim(g), '^[0-9, ]+$')), nums AS (SELECT DISTINCT doc_name, chunk_id, t, CAST(p AS INT) AS n FROM n WHERE regexp_matches(p, '^\\d+$') AND CAST(p AS BIGINT) BETWEEN 1 AND 99),
  o AS (SELECT claim_id, doc_name, substr({_FOLD.format(c='claim')}, 1, 200) AS needle FROM claims WHERE length(trim(claim)) >= 30 AND (doc_name, chunk_id + 1) NOT IN (SELECT doc_name, chunk_id FROM nums))
  SELECT claim_id, string_agg(DISTINCT CAST(n AS VARCHAR), ',' ORDER BY CAST(n AS VARCHAR)) AS numbers FROM o JOIN nums ON o.doc_name = nums.doc_name AND contains(nums.t, o.needle) GROUP BY claim_id""")
def _(spark, d):
    b = CI.borrow_citations(claims(spark, d).select("claim_id", "doc_name", (F.col("chunk_id") + 1).alias("chunk_id"), "claim"), chunk_table(spark, d), max_ref=99, bare=False)
    return b.select("claim_id", F.array_join(F.array_sort(F.col("numbers").cast("array<string>")), ",").alias("numbers"))


@query("context_window", cte("claims") + " SELECT c.claim_id, d.doc_id AS chunk_id FROM claims c JOIN documents d ON d.source = c.doc_name AND d.doc_id BETWEEN c.chunk_id - 9 AND c.chunk_id + 9")
def _(spark, d):
    return CI.context_window(claims(spark, d), chunk_table(spark, d), k=9).select("claim_id", "chunk_id")


@query("context_sections", cte("claims") + f""", {CHUNKS}, p AS (SELECT c.claim_id, k.chunk_id, abs(k.chunk_id - c.chunk_id) <= 1 AS near, '[' || k.section_heading || ']' || chr(10) || k.text AS part,
    lower(k.section_heading) AS h, c.claim_type AS t FROM claims c JOIN chunks k USING (doc_name)),
  q AS (SELECT *, sum(length(part)) OVER (PARTITION BY claim_id, near ORDER BY chunk_id) - length(part) AS used FROM p WHERE near OR CASE t WHEN 'Fact' THEN regexp_matches(h, 'result|finding|data|efficacy')
    WHEN 'Assertion' THEN regexp_matches(h, 'result|discussion|conclusion') WHEN 'Roadmap' THEN regexp_matches(h, 'discussion|conclusion') ELSE regexp_matches(h, 'method|result|conclusion') END),
  j AS (SELECT claim_id, string_agg(substr(part, 1, (3000 - used)::INT), chr(10) || chr(10) ORDER BY NOT near, chunk_id) AS context FROM q WHERE used < 3000 GROUP BY claim_id)
  SELECT claim_id, sha256(regexp_replace(context, '\\s+$', '')) AS context FROM j""")
def _(spark, d):
    return CI.context_sections(claims(spark, d), chunk_table(spark, d)).select("claim_id", F.sha2("context", 256).alias("context"))


@query("rebuild_abstract", "SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS abstract FROM documents WHERE trim(text) <> ''")
def _(spark, d):
    inv = docs(spark, d).select("doc_id", T.words("text").alias("ws")).filter("size(ws) > 0").select("doc_id", T.word_places("ws").alias("inv"))
    return inv.select("doc_id", CI.rebuild_abstract("inv").alias("abstract"))


@query("outline", f"WITH {CHUNKS} SELECT doc_name, section_heading AS heading, min(chunk_id) AS first_pos, count(*) AS chunks, string_agg(nullif(trim(text), ''), '\n\n' ORDER BY chunk_id) AS body FROM chunks GROUP BY ALL")
def _(spark, d):
    return CI.outline(chunk_table(spark, d), ["doc_name"], "section_heading", "chunk_id", "text")


@query("doc_title", f"WITH {CHUNKS}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_name ORDER BY chunk_id) AS rn FROM chunks) SELECT doc_name, section_heading AS title FROM r WHERE rn <= 5 QUALIFY row_number() OVER (PARTITION BY doc_name ORDER BY length(section_heading) DESC, rn) = 1")
def _(spark, d):
    return CI.doc_title(chunk_table(spark, d), "doc_name", "chunk_id", "section_heading")


@query("doc_abstract", f"WITH {CHUNKS} SELECT doc_name, nullif(trim(text), '') AS abstract FROM chunks WHERE semantic_category = 'abstract' QUALIFY row_number() OVER (PARTITION BY doc_name ORDER BY chunk_id) = 1")
def _(spark, d):
    return CI.doc_abstract(chunk_table(spark, d), "doc_name", "chunk_id", "text", "semantic_category", "section_heading")


@query("extractable_chunks", f"WITH {CHUNKS} SELECT chunk_id FROM chunks WHERE section_heading <> 'References' AND (chunk_id % 5 = 0 OR length(trim(text)) >= 80)")
def _(spark, d):
    c = chunk_table(spark, d).withColumn("hints", F.when(F.col("chunk_id") % 5 == 0, F.array(F.lit("h"))).otherwise(F.array().cast("array<string>")))
    return CI.extractable_chunks(c).select("chunk_id")


# --- W1-W16 -----------------------------------------------------------------------------------------
@query("top_under_budget", cte("works") + """, w AS (SELECT *, 100 + work_id % 50 AS cost FROM works), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, work_id) AS rank FROM w),
  s AS (SELECT *, sum(cost) OVER (PARTITION BY doc_id ORDER BY rank) AS running_cost FROM r) SELECT doc_id, work_id, rank, running_cost FROM s WHERE rank = 1 OR running_cost <= 700""")
def _(spark, d):
    w = view(spark, d, "works").withColumn("cost", F.col("work_id") % 50 + 100)
    return K.top_under_budget(w, ["doc_id"], [F.desc("similarity"), "work_id"], "cost", 700).select("doc_id", "work_id", "rank", "running_cost")


@query("top_k", cte("lines") + ", r AS (SELECT line_id, category, row_number() OVER (PARTITION BY category ORDER BY verdict, line_id) AS rank, count(*) OVER (PARTITION BY category) AS n FROM lines) SELECT line_id, category, rank, greatest(n - 60, 0) AS omitted FROM r WHERE rank <= 60")
def _(spark, d):
    return K.top_k(view(spark, d, "lines"), ["category"], ["verdict", "line_id"], 60).select("line_id", "category", "rank", "omitted")


_WORDS = "list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')"


@query("sliding_windows", f"WITH x AS (SELECT doc_id, {_WORDS} AS w FROM documents), e AS (SELECT doc_id, w, unnest(range(0, CAST(ceil(greatest(len(w) - 100, 0) / 80.0) AS INT) + 1)) AS i FROM x WHERE len(w) > 0) SELECT doc_id, i AS window_idx, array_to_string(w[i * 80 + 1 : i * 80 + 100], ' ') AS text FROM e")
def _(spark, d):
    return P.sliding_windows(docs(spark, d), ["doc_id"], "text", 100, 80).select("doc_id", "window_idx", "text")


@query("fixed_chunks", f"WITH x AS (SELECT doc_id, {_WORDS} AS w FROM documents), e AS (SELECT doc_id, w, unnest(range(0, (len(w) - 1) // 50 + 1)) AS i FROM x WHERE len(w) > 0) SELECT doc_id, i AS chunk_no, 'chunk_' || i AS section_heading, array_to_string(w[i * 50 + 1 : i * 50 + 50], ' ') AS text FROM e")
def _(spark, d):
    return P.fixed_chunks(docs(spark, d), ["doc_id"], "text", 50)


@query("batches", cte("works") + " SELECT doc_id, work_id, (row_number() OVER (PARTITION BY doc_id ORDER BY work_id) - 1) // 5 AS batch FROM works")
def _(spark, d):
    return K.batches(view(spark, d, "works").select("doc_id", "work_id"), ["doc_id"], "work_id", 5)


@query("pack_paragraphs")
def _(spark, d):
    return P.pack_paragraphs(docs(spark, d), ["doc_id"], "text", 800, 200, r"\n")


@query("pack_by_cost")
def _(spark, d):
    return P.pack_by_cost(view(spark, d, "findings"), ["doc_id", "dimension"], "seq", "observation", 300).select("doc_id", "dimension", "pack", "items", "text")


@query("pack_transcript")
def _(spark, d):
    return P.pack_transcript(table(spark, d, "conversations"), ["conv_id"], "turn", "text", 800).select("conv_id", "pack", "items", "text")


@query("concat_budget", cte("findings") + """, s AS (SELECT doc_id, seq, observation AS t, coalesce(sum(length(observation) + 2) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM findings WHERE observation <> '')
  SELECT doc_id, string_agg(substr(t, 1, CAST(600 - start AS BIGINT)), '\n\n' ORDER BY seq) AS text, count(*) AS parts FROM s WHERE start < 600 GROUP BY doc_id""")
def _(spark, d):
    return K.concat_budget(view(spark, d, "findings"), ["doc_id"], ["seq"], "observation", 600)


@query("number_rows", "SELECT doc_id, source, 100 + row_number() OVER (PARTITION BY source ORDER BY doc_id) AS row_no FROM documents")
def _(spark, d):
    return K.number_rows(docs(spark, d).select("doc_id", "source"), "doc_id", ["source"], 101, block=64)


@query("number_rows_by", "SELECT doc_id, row_number() OVER (ORDER BY text, doc_id) AS row_no FROM documents")
def _(spark, d):
    return K.number_rows_by(docs(spark, d).select("doc_id", "text"), ["text", "doc_id"]).select("doc_id", "row_no")


@query("latest", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def _(spark, d):
    return K.latest(table(spark, d, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts", "event_id").select("user_id", "event_id")


@query("pick_smallest", "SELECT doc_id FROM documents ORDER BY n_chars, doc_id LIMIT 25")
def _(spark, d):
    return K.pick_smallest(docs(spark, d), "n_chars", "doc_id", 25).select("doc_id")


@query("pick_shuffled", "SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || ':7'), doc_id LIMIT 25")
def _(spark, d):
    return K.pick_shuffled(docs(spark, d), "doc_id", 7, 25).select("doc_id")


@query("overlap_join", """WITH s AS (SELECT conv_id, turn * 3.5e0 AS st, turn * 3.5e0 + length(text) % 9 AS en, text FROM conversations), w AS (SELECT range AS k FROM range(0, 60)), j AS (SELECT conv_id, k, st, en, text FROM s JOIN w ON st < k * 5 + 5 AND en > k * 5 AND en > st)
  SELECT conv_id, k AS window_no, count(*) AS segments, string_agg(text, ' ' ORDER BY st, en, text) AS text FROM j GROUP BY ALL""")
def _(spark, d):
    s = table(spark, d, "conversations").selectExpr("conv_id", "turn * 3.5D AS start", "turn * 3.5D + length(text) % 9 AS end", "text")
    return P.overlap_join(s, ["conv_id"])


@query("split_pages", """WITH p AS (SELECT source, doc_id AS page, string_split(text, chr(10)) AS ls FROM documents), l AS (SELECT source, page, unnest(ls) AS raw, generate_subscripts(ls, 1) - 1 AS pos FROM p),
  m AS (SELECT *, CASE WHEN pos % 3 = 0 THEN '## ' || substr(raw, 1, 20) ELSE raw END AS line FROM l), h AS (SELECT *, nullif(regexp_extract(line, '^#{1,6}\\s+(.+?)\\s*$', 1), '') AS head FROM m),
  n AS (SELECT *, count(head) OVER (PARTITION BY source ORDER BY page, pos) AS section_no FROM h)
  SELECT source, section_no, coalesce(max(head), 'Body') AS heading, min(page) AS page_start, max(page) AS page_end,
    length(trim(coalesce(string_agg(line, chr(10) ORDER BY page, pos) FILTER (head IS NULL), ''), ' ' || chr(9) || chr(10) || chr(13))) AS chars FROM n GROUP BY source, section_no""")
def _(spark, d):
    base = docs(spark, d).select(F.col("source"), F.col("doc_id").alias("page"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return P.split_pages(base.withColumn("line", F.when(F.col("pos") % 3 == 0, F.concat(F.lit("## "), F.substring("line", 1, 20))).otherwise(F.col("line"))), "source", "page", "pos", "line").select(
        "source", "section_no", "heading", "page_start", "page_end", F.length("body").alias("chars"))


# --- D2, D8-D14 ---------------------------------------------------------------------------------------
@query("distinct_first", "SELECT doc_id FROM documents QUALIFY doc_id % 6 = 0 OR row_number() OVER (PARTITION BY CASE WHEN doc_id % 6 = 0 THEN -doc_id - 1 ELSE doc_id % 50 END ORDER BY doc_id) = 1")
def _(spark, d):
    return K.distinct_first(docs(spark, d), F.expr("CASE WHEN doc_id % 6 <> 0 THEN doc_id % 50 END"), ["doc_id"]).select("doc_id")


@query("distinct_works", cte("works") + " SELECT doc_id, work_id, search_term FROM works QUALIFY row_number() OVER (PARTITION BY doc_id, openalex_id ORDER BY work_id) = 1")
def _(spark, d):
    return K.first_rows(view(spark, d, "works"), ["doc_id", "openalex_id"], ["work_id"]).select("doc_id", "work_id", "search_term")


@query("distinct_terms", "SELECT conv_id, turn FROM conversations WHERE trim(text) <> '' QUALIFY row_number() OVER (PARTITION BY lower(trim(text)) ORDER BY conv_id, turn) = 1")
def _(spark, d):
    c = table(spark, d, "conversations")
    return K.first_rows(c.filter("trim(text) <> ''"), [F.lower(F.trim("text"))], ["conv_id", "turn"]).select("conv_id", "turn")


@query("distinct_files", "SELECT doc_id FROM documents WHERE trim(text) = '' UNION ALL SELECT doc_id FROM (SELECT doc_id FROM documents WHERE trim(text) <> '' QUALIFY row_number() OVER (PARTITION BY source, trim(text) ORDER BY doc_id) = 1)")
def _(spark, d):
    t = F.trim("text")
    return K.distinct_first(docs(spark, d), F.when(t != "", F.struct("source", t)), ["doc_id"]).select("doc_id")


@query("distinct_urls", "SELECT page_id FROM pages QUALIFY row_number() OVER (PARTITION BY rtrim(split_part(url, '#', 1), '/') ORDER BY page_id) = 1")
def _(spark, d):
    return K.first_rows(table(spark, d, "pages"), [F.rtrim(F.substring_index("url", "#", 1), F.lit("/"))], ["page_id"]).select("page_id")


@query("distinct_excerpts", "SELECT DISTINCT source, substr(text, 1, 2000) AS excerpt FROM documents")
def _(spark, d):
    return docs(spark, d).select("source", F.substring("text", 1, 2000).alias("excerpt")).distinct()


