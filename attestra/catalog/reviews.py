"""Queries for lines, files, feeds, profiles, model passes, reports and the batch twins of the streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestra import config as C
from attestra.catalog.claims import members
from attestra.catalog.compounds import KEY, MAT, material
from attestra.catalog.jobs import docs
from attestra.catalog.registry import query
from attestra.catalog.texts import LINK_CTE, links
from attestra.fixtures import claims, cte, table, view
from attestra.functions.text import truncate
from attestra.operators import gates as G
from attestra.operators import lines as L
from attestra.operators import material as M
from attestra.operators import model as MO
from attestra.operators import reports as RP
from attestra.operators import scoring as S
from attestra.sources import records as R
from attestra.session import cut_lineage
from attestra.streaming import rounds as ST


# --- P21..P43 -----------------------------------------------------------------------------------------
@query("active_campaigns", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 9 <> 0 AND o_orderdate > TIMESTAMP '1996-06-01'")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.expr("CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'CLOSED' END").alias("status"), F.expr("CASE WHEN o_orderkey % 9 <> 0 THEN cast(o_orderdate as string) END").alias("end_date"))
    return L.active_campaigns(o, "1996-06-01 00:00:00").select("o_orderkey")


@query("profile_skip_reason", "SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'fetch_error' WHEN doc_id % 10 = 1 THEN 'not_in_data_api' WHEN doc_id % 10 = 2 THEN 'thin_metadata' WHEN length(trim(substr(text, 1, CAST(doc_id % 50 AS BIGINT)))) >= 40 OR (length(trim(substr(text, 1, CAST(doc_id % 50 AS BIGINT)))) >= 12 AND lang = 'fr') THEN NULL ELSE 'thin_metadata' END AS reason FROM documents")
def _(spark, d):
    p = docs(spark, d).selectExpr("doc_id", "CASE WHEN doc_id % 10 <> 2 THEN source END AS name", "substr(text, 1, cast(doc_id % 50 as int)) AS description", "CASE WHEN lang = 'fr' THEN 'x' END AS topic",
                                  "'' AS organization", "'' AS token_uri", "'' AS external_url", "'' AS image")
    return p.select("doc_id", L.profile_skip_reason(F.col("doc_id") % 10 != 1, F.col("doc_id") % 10 == 0).alias("reason"))


@query("follow_candidates", f"""WITH {LINK_CTE} SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'blocked_anchor' WHEN rtrim(link, '/') IN (SELECT rtrim(link, '/') FROM l WHERE page_id % 23 = 1) THEN 'already_in_links_json'
  WHEN rtrim(link, '/') IN (SELECT rtrim(link, '/') FROM l WHERE page_id % 29 = 1) THEN 'already_planned' WHEN page_id % 14 IN (0, 2, 12) AND page_id % 14 <> 2 THEN 'non_http' WHEN page_id % 14 = 2 THEN 'non_http' WHEN page_id % 14 IN (8, 11) THEN 'deferred'
  WHEN page_id % 14 = 1 THEN 'social_deferred' WHEN page_id % 14 IN (3, 4) THEN 'explorer_deferred' WHEN page_id % 14 = 10 THEN 'molecule_footer_blocked' WHEN page_id % 14 IN (5, 6, 7) THEN 'molecule_ecosystem_blocked' END AS reason FROM l WHERE page_id % 14 <> 13""")
def _(spark, d):
    ln = links(spark, d).filter("page_id % 14 <> 13").select("page_id", F.col("link").alias("url"), F.when(F.col("page_id") % 11 == 0, "Sign  in").otherwise("read").alias("text"), F.lit("https://seed.test/").alias("seed_url"))
    every = links(spark, d).select("page_id", F.col("link").alias("url"))
    return L.follow_candidates(ln, every.filter("page_id % 23 = 1"), every.filter("page_id % 29 = 1")).select("page_id", "reason")


_FILE = "CASE doc_id % 8 WHEN 0 THEN 'Paper.PDF' WHEN 1 THEN 'Brand Guide.png' WHEN 2 THEN 'a.b.jpeg' WHEN 3 THEN 'clip.mov' WHEN 4 THEN 'links.json' WHEN 5 THEN 'notes' WHEN 6 THEN 'data.csv' ELSE 'x.unknown' END"
_ROUTE = "CASE doc_id % 8 WHEN 0 THEN 'pdf' WHEN 1 THEN 'skip' WHEN 2 THEN 'image' WHEN 3 THEN 'video' WHEN 4 THEN 'skip' WHEN 5 THEN CASE WHEN doc_id % 3 = 0 THEN 'pdf' ELSE 'skip' END WHEN 6 THEN 'text' ELSE CASE WHEN doc_id % 3 = 0 THEN 'pdf' ELSE 'skip' END END"


@query("file_route", f"SELECT doc_id, {_ROUTE} AS route FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", L.file_route(F.expr(_FILE), F.expr("CASE WHEN doc_id % 3 = 0 THEN 'Application/PDF; x' END")).alias("route"))


@query("file_inventory", f"WITH m AS (SELECT source, doc_id, {_FILE} AS file_name FROM documents QUALIFY row_number() OVER (PARTITION BY source, {_FILE} ORDER BY doc_id) = 1) SELECT source, doc_id, file_name, {_ROUTE} AS route FROM m WHERE {_ROUTE} <> 'skip'")
def _(spark, d):
    m = docs(spark, d).select("source", "doc_id", F.expr(f"CASE WHEN doc_id % 2 = 0 THEN {_FILE} ELSE '' END").alias("file_name"), F.concat(F.lit("/p/"), "doc_id", F.lit("/"), F.expr(_FILE)).alias("path"))
    room = docs(spark, d).filter("doc_id % 3 = 0").select("source", F.concat(F.lit("/p/"), "doc_id", F.lit("/"), F.expr(_FILE)).alias("path"), F.lit("application/pdf").alias("content_type"))
    return L.inventory(m, room, ["source"], ["doc_id"]).select("source", "doc_id", "file_name", "route")


def files(spark, d):
    return docs(spark, d).selectExpr("source", "doc_id", "concat('did', doc_id) AS did", "concat('/', lang) AS path", "cast(doc_id % 5 as int) AS version", "CASE WHEN doc_id % 3 = 0 THEN 'PUBLIC' ELSE 'ADMIN' END AS access_level",
                                     "CASE WHEN lang = 'en' THEN 'application/pdf' ELSE 'text/plain' END AS content_type")


@query("public_files", "SELECT doc_id FROM documents WHERE doc_id % 3 = 0 AND lang = 'en'")
def _(spark, d):
    return L.public_files(files(spark, d)).select("doc_id")


@query("dataroom_hash", "SELECT source, '1:' || sha256(string_agg(sha256('did' || doc_id || ':/' || lang || ':' || (doc_id % 5)), '' ORDER BY sha256('did' || doc_id || ':/' || lang || ':' || (doc_id % 5)))) AS fingerprint FROM documents WHERE doc_id % 3 = 0 GROUP BY source")
def _(spark, d):
    return L.dataroom_hash(files(spark, d), ["source"])


@query("publishable_bundles", "SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING bool_or(l_linenumber = 1) AND bool_or(l_linenumber = 2) AND bool_or(l_linenumber = 4)")
def _(spark, d):
    f = table(spark, d, "lineitem").select("l_orderkey", F.expr("CASE l_linenumber WHEN 1 THEN 'evidence_audit.md' WHEN 2 THEN 'overview.json' WHEN 4 THEN 'x-review.json' ELSE 'other' END").alias("file_name"))
    return L.publishable_bundles(f, "l_orderkey")


@query("audit_filter", cte("claims") + " SELECT claim_id FROM claims WHERE evidence_grade NOT IN ('self_reported', 'self_reported_method', 'strong', 'moderate')")
def _(spark, d):
    return L.audit_filter(claims(spark, d), False, True).select("claim_id")


@query("clean_findings", cte("findings") + " SELECT finding_id, dimension, CASE WHEN severity = 'bogus' THEN 'info' ELSE severity END AS severity FROM findings WHERE dimension <> 'real_world_traction'")
def _(spark, d):
    return L.clean_findings(view(spark, d, "findings"), ("team_credibility", "financial_integrity", "cross_cutting")).select("finding_id", "dimension", "severity")


@query("fallback_category", cte("lines") + " SELECT line_id, CASE WHEN source_kind = 'onchain_fact' THEN CASE lang WHEN 'en' THEN 'team_credibility' WHEN 'fr' THEN 'mission_clarity' ELSE 'governance_tokenomics' END WHEN line_type = 'mission' THEN 'mission_clarity' WHEN line_type = 'claim' THEN 'scientific_grounding' WHEN line_type = 'feature' THEN 'research_output_quality' ELSE 'execution_competence' END AS cat FROM lines")
def _(spark, d):
    ln = view(spark, d, "lines").withColumn("section", F.expr("CASE lang WHEN 'en' THEN 'research_lead' WHEN 'fr' THEN 'Description' WHEN 'de' THEN 'funding' END"))
    return ln.select("line_id", L.fallback_category().alias("cat"))


@query("clean_lines", cte("lines") + " SELECT line_id, CASE WHEN line_type = 'other' THEN 'feature' ELSE line_type END AS line_type, substr(trim(text), 1, 500) AS text FROM (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY source_path ORDER BY line_id) <= 6) WHERE trim(text) <> ''")
def _(spark, d):
    ln = view(spark, d, "lines").withColumn("line_type", F.upper("line_type")).withColumn("verbatim_quote", F.col("text"))
    return L.clean_lines(ln, ["source_path"], ["line_id"]).select("line_id", "line_type", "text")


@query("clean_verdicts", cte("lines") + " SELECT line_id, CASE WHEN line_id % 2 = 0 THEN CASE WHEN verdict NOT IN ('valid', 'invalid', 'inconclusive') THEN 'inconclusive' WHEN verdict = 'valid' AND line_id % 4 = 0 THEN 'inconclusive' ELSE verdict END ELSE CASE WHEN verdict IN ('positive', 'negative', 'neutral') THEN verdict ELSE 'neutral' END END AS verdict, CASE WHEN line_id % 2 = 0 AND line_id % 4 <> 0 THEN 1 ELSE 0 END AS n FROM lines")
def _(spark, d):
    ln = view(spark, d, "lines").withColumns({"needs_scientific_support": F.col("line_id") % 2 == 0, "citations": F.array(F.when(F.col("line_id") % 4 == 0, " X").otherwise("W1 "), F.lit("W9")),
                                              "retrieved": F.array(F.lit("W1"), F.lit("W2"))})
    return L.clean_verdicts(ln).select("line_id", "verdict", F.size("citations").alias("n"))


@query("scope_findings", cte("findings") + ", s AS (SELECT * FROM findings WHERE regexp_matches(lower(observation), 'budget|cost|fund|scope|timeline|personnel|equipment|method')) SELECT finding_id FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY seq) <= 8")
def _(spark, d):
    return L.scope_findings(view(spark, d, "findings"), ["doc_id"], ["seq"]).select("finding_id")


@query("reviewable_items", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN CASE WHEN doc_id % 8 = 0 THEN 'no_pdf_url' END WHEN 1 THEN CASE WHEN doc_id % 3 <> 0 THEN 'no_profile' END WHEN 2 THEN CASE WHEN doc_id % 5 = 0 THEN 'no_ticker_or_names' END END AS reject_reason FROM documents")
def _(spark, d):
    i = docs(spark, d).selectExpr("doc_id", "CASE doc_id % 4 WHEN 0 THEN 'article' WHEN 1 THEN 'dao' WHEN 2 THEN 'compounds' ELSE 'proposal' END AS route", "CASE WHEN doc_id % 8 <> 0 THEN 'http://p' END AS pdf_url", "doc_id % 3 = 0 AS has_profile",
                                  "'T' AS ticker", "CASE WHEN doc_id % 5 <> 0 THEN array('n') ELSE array() END AS names")
    return L.reviewable_items(i).select("doc_id", "reject_reason")


_REV = "r AS (SELECT conv_id, 'd' || turn AS dimension, turn / 10.0 AS score, text AS rationale FROM conversations WHERE turn < 4)"


@query("patch_categories", f"""WITH {_REV}, n AS (SELECT conv_id, 'd' || (turn + 2) AS dimension, text AS nw, turn AS seq, CASE turn % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS sev FROM conversations), u AS (SELECT conv_id, count(*) AS used FROM r GROUP BY ALL),
  f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY sev, seq) AS rk FROM n WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.conv_id = n.conv_id AND r.dimension = n.dimension))
  SELECT r.conv_id, r.dimension, CAST(r.score AS DOUBLE) AS score, nw IS NOT NULL AS changed FROM r LEFT JOIN n ON n.conv_id = r.conv_id AND n.dimension = r.dimension UNION ALL SELECT f.conv_id, dimension, NULL, TRUE FROM f LEFT JOIN u USING (conv_id) WHERE rk <= 6 - coalesce(used, 0)""")
def _(spark, d):
    c = table(spark, d, "conversations")
    review = c.filter("turn < 4").selectExpr("conv_id", "concat('d', turn) AS dimension", "cast(turn / 10.0 as double) AS score", "text AS rationale")
    new = c.selectExpr("conv_id", "concat('d', turn + 2) AS dimension", "text AS rationale", "1 AS finding_count", "CASE turn % 3 WHEN 0 THEN 'info' WHEN 1 THEN 'concern' ELSE 'red_flag' END AS worst", "turn AS seq")
    out = L.patch_categories(review, new, ["conv_id"]).withColumnRenamed("rationale", "_r")
    return out.join(review.select("conv_id", "dimension", "rationale"), ["conv_id", "dimension"], "left").select("conv_id", "dimension", "score", (~F.col("_r").eqNullSafe(F.col("rationale"))).alias("changed"))


def cited_lines(spark, d):
    w = lambda e: F.struct(F.concat(F.lit("W"), e.cast("string")).alias("work_id"), F.concat(F.lit("t"), F.col("line_id").cast("string")).alias("title"))
    ln = view(spark, d, "lines").withColumn("retrieved_works", F.array(w(F.col("line_id") % 20), w(F.col("line_id") % 7)))
    return ln.withColumn("citations", F.array(F.concat(F.lit("W"), (F.col("line_id") % 20).cast("string")), F.concat(F.lit("W"), (F.col("line_id") % 7).cast("string")))).withColumns(
        {"domain": F.col("source_path"), "doc_title": F.col("lang")})


@query("citation_usage", "WITH u AS (SELECT DISTINCT doc_id, 'W' || n AS work_id FROM (SELECT doc_id, doc_id % 20 AS n FROM documents UNION ALL SELECT doc_id, doc_id % 7 FROM documents)) SELECT work_id, count(*) AS lines, min(doc_id) AS first_line, 't' || min(doc_id) AS title FROM u GROUP BY work_id")
def _(spark, d):
    return L.citation_usage(cited_lines(spark, d))


@query("source_rollup", cte("lines") + """, k AS (SELECT *, CASE WHEN source_kind = 'onchain_fact' THEN 'onchain' WHEN source_kind = 'crawl_md' THEN 'crawl::' || source_path WHEN source_kind = 'pdf' THEN 'pdf::' || lang WHEN source_kind = 'image_caption' THEN 'image::' || lang WHEN source_kind = 'video_transcript' THEN 'video::' || lang WHEN source_kind = 'text_doc' THEN 'text::' || lang ELSE source_kind || '::' || lang END AS key FROM lines),
  c AS (SELECT key, count(*) AS chunks FROM k WHERE line_id % 3 <> 0 GROUP BY key), n AS (SELECT key, count(*) AS lines, count(*) FILTER (verdict IN ('valid', 'positive')) AS favorable, count(*) FILTER (verdict IN ('invalid', 'negative')) AS unfavorable FROM k WHERE line_id % 2 = 0 GROUP BY key)
  SELECT key, coalesce(chunks, 0) AS chunks, coalesce(lines, 0) AS lines, coalesce(favorable, 0) AS favorable, coalesce(unfavorable, 0) AS unfavorable, CASE WHEN key LIKE 'crawl::%' THEN 0 WHEN key = 'onchain' THEN 1 WHEN key LIKE 'pdf::%' THEN 2 WHEN key LIKE 'video::%' THEN 3 WHEN key LIKE 'image::%' THEN 4 ELSE 5 END AS rank FROM c FULL JOIN n USING (key)""")
def _(spark, d):
    ln = cited_lines(spark, d)
    return L.source_rollup(ln.filter("line_id % 3 <> 0"), ln.filter("line_id % 2 = 0"))


@query("counts_by", cte("lines") + " SELECT source_kind, line_type, count(*) AS n FROM lines GROUP BY ALL")
def _(spark, d):
    return L.counts_by(view(spark, d, "lines"), "source_kind", "line_type")


@query("artifact_tags", "SELECT doc_id, 'doctype=review;platform=ResearchHub;category=Article;research_name=' || source || CASE WHEN doc_id % 2 = 0 THEN ';review_date=June 2, 2026' ELSE '' END AS article, 'doctype=review;DaoName=' || source || ';platform=Molecule;category=ResearchDAO' || CASE WHEN doc_id % 2 = 0 THEN ';date=June 2, 2026' ELSE '' END AS dao FROM documents")
def _(spark, d):
    ctx = {"name": F.col("source"), "review_date": F.expr("CASE WHEN doc_id % 2 = 0 THEN 'June 2, 2026' ELSE '' END")}
    show = lambda r: F.array_join(F.transform(L.artifact_tags(r, F.lit("review"), ctx), lambda t: F.concat_ws("=", t["name"], t["value"])), ";")
    return docs(spark, d).select("doc_id", show("article").alias("article"), show("dao").alias("dao"))


@query("with_field_after", """SELECT doc_id, '{"research_name":"' || doc_id || '","review_date":"[d]","evidence_audit":"tx' || doc_id || '","source":"' || source || '","composite_score":' || (doc_id % 100) || ',"tags":["a"]}' AS document FROM documents""")
def _(spark, d):
    doc = F.to_json(F.struct(F.col("doc_id").cast("string").alias("research_name"), F.lit("[d]").alias("review_date"), "source", (F.col("doc_id") % 100).alias("composite_score"), F.array(F.lit("a")).alias("tags"), F.lit("old").alias("evidence_audit")))
    return docs(spark, d).withColumn("_doc", doc).select("doc_id", L.with_field_after("_doc", "evidence_audit", F.concat(F.lit("tx"), F.col("doc_id").cast("string"))).alias("document"))


# --- S1, S5-S10, S13, S14, S19, H16 ---------------------------------------------------------------------
@query("jsonl_scan", "SELECT doc_id, lang FROM documents WHERE doc_id % 4 IN (0, 1)")
def _(spark, d):
    js = F.to_json(F.struct("doc_id", "lang", "text"))
    t = docs(spark, d).select(F.when(F.col("doc_id") % 4 < 2, js).when(F.col("doc_id") % 4 == 2, F.concat(F.lit("[1,"), js, F.lit("]"))).otherwise(F.concat(F.lit("{"), js)).alias("value"))
    r = R.parse_jsonl(t)
    return r.select(F.try_variant_get("record", "$.doc_id", "long").alias("doc_id"), F.try_variant_get("record", "$.lang", "string").alias("lang"))


@query("paper_records", """SELECT o_orderkey AS paper_id, 'https://www.researchhub.com/paper/' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '/s' || o_custkey ELSE '/feed' END AS url, CASE WHEN o_orderkey % 2 = 0 THEN 'D' || o_orderpriority ELSE 'F' || o_orderstatus END AS title,
  'https://x.test/a%20b/' || o_orderkey || '.pdf' AS pdf_url, (SELECT string_agg('A ' || l_linenumber, ',' ORDER BY l_linenumber, l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS authors FROM orders""")
def _(spark, d):
    o = table(spark, d, "orders")
    none = [F.lit(None).cast("string").alias(c) for c in ("abstract", "doi", "work_type", "created_date", "paper_publish_date")]
    feed = o.select(F.col("o_orderkey").alias("paper_id"), F.concat(F.lit("F"), "o_orderstatus").alias("title"), F.lit("feed").alias("slug"), F.lit("2024").alias("action_date"), *none)
    det = o.select(F.col("o_orderkey").alias("paper_id"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN concat('D', o_orderpriority) ELSE '' END").alias("title"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN concat('s', o_custkey) END").alias("slug"),
                   F.concat(F.lit("https://x.test/a b/"), "o_orderkey", F.lit(".pdf")).alias("pdf_url"), *none)
    au = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("paper_id"), F.struct("l_linenumber", "l_partkey").alias("pos"), F.lit(" A").alias("first_name"), F.col("l_linenumber").cast("string").alias("last_name"), F.col("l_partkey").alias("author_id"))
    return R.paper_records(feed, det, au).select("paper_id", "url", "title", "pdf_url", F.array_join(F.transform("authors", lambda a: a["name"]), ",").alias("authors"))


@query("proposal_records", "SELECT o_orderkey AS id, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'D' || o_orderpriority END, 'F') AS title, o_totalprice AS goal_amount, 'https://www.researchhub.com/post/' || o_orderkey || '/post' AS url, 'Hi ' || o_orderstatus || '\nYou & me' AS body FROM orders")
def _(spark, d):
    o = table(spark, d, "orders")
    feed = o.select(F.col("o_orderkey").alias("id"), F.lit("F").alias("title"), F.lit(" ").alias("slug"), F.struct(F.lit(1.0).alias("usd")).alias("amount_raised"), F.struct(F.col("o_totalprice").alias("usd")).alias("goal_amount"),
                    F.struct(F.lit(3).alias("total")).alias("contributors"), F.lit("c").alias("created_date"), F.lit("s").alias("start_date"), F.lit("e").alias("end_date"), F.lit("t").alias("type"))
    det = o.select(F.col("o_orderkey").alias("id"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN concat('D', o_orderpriority) END").alias("title"), F.lit("c").alias("created_date"), F.lit("t").alias("document_type"),
                   F.concat(F.lit("<p>Hi "), "o_orderstatus", F.lit("</p>\n<p>You &amp; me</p>")).alias("full_markdown"))
    return R.proposal_records(feed, det).select("id", "title", "goal_amount", "url", "body")


@query("markdown_documents", "WITH f AS (SELECT source, doc_id, text, lang || CASE WHEN doc_id % 2 = 0 THEN '.site' ELSE '' END AS stem FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang, doc_id % 2 ORDER BY doc_id) = 1) SELECT source, stem, CASE WHEN contains(stem, '.') THEN stem ELSE '' END AS domain, text FROM f WHERE trim(text) <> ''")
def _(spark, d):
    f = docs(spark, d).select("source", "doc_id", F.concat(F.lit("/a/"), "doc_id", F.lit("/"), "lang", F.when(F.col("doc_id") % 2 == 0, ".site").otherwise(""), F.lit(".md")).alias("path"), F.concat(F.lit("---\nt: 1\n---\n"), "text").alias("text"))
    return R.markdown_documents(f, "path", "text", ["doc_id"], ["source"]).select("source", "stem", "domain", "text")


@query("text_chunks")
def _(spark, d):
    return R.text_chunks(docs(spark, d).select(F.concat("source", F.lit("."), F.col("doc_id").cast("string")).alias("stem"), F.col("source").alias("domain"), F.concat(F.lit("# T\n"), F.replace("text", F.lit("\n"), F.lit("\n\n"))).alias("text")), "crawl_md", 900).select("chunk_id", "section", "domain", "text")


@query("bundle_chunks")
def _(spark, d):
    base = docs(spark, d)
    pdf = base.select("source", "doc_id", "text").groupBy(F.col("source").alias("stem")).agg(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda s: F.struct(F.lit("").alias("heading"), s["text"].alias("text"), s["doc_id"].cast("int").alias("page_start"))).alias("sections")).withColumn("title", F.col("stem"))
    img = base.select(F.concat(F.lit("i"), "doc_id").alias("stem"), F.substring("text", 1, 80).alias("description"), F.lit("").alias("transcribed"), F.array("lang").alias("labels"))
    conv = table(spark, d, "conversations")
    frames = conv.select(F.concat(F.lit("v"), "conv_id").alias("stem"), F.col("turn").alias("pos"), (F.col("turn") * 5).alias("ts"), F.col("text").alias("audio"), F.substring("text", 1, 60).alias("description"), F.lit("").alias("embedded"))
    return R.bundle_chunks(pdf, img, frames).select("chunk_id", "source_kind", "page", "section", "text")


@query("rss_posts", "SELECT conv_id, turn AS pos, CAST(conv_id * 100 + turn AS VARCHAR) AS post_id, 'h' || conv_id AS author FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 20")
def _(spark, d):
    item = F.concat(F.lit("<item><title>t</title><link>https://nitter.net/h"), "conv_id", F.lit("/status/"), (F.col("conv_id") * 100 + F.col("turn")).cast("string"), F.lit("</link><description>&lt;p&gt;x &amp;amp; y&lt;/p&gt;</description></item>"))
    feeds = table(spark, d, "conversations").groupBy("conv_id").agg(F.concat(F.lit("<rss><channel><title>c</title>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", item.alias("i")))), lambda s: s["i"]), ""), F.lit("</channel></rss>")).alias("xml"))
    return R.rss_posts(feeds, ["conv_id"]).select("conv_id", F.col("pos").cast("bigint").alias("pos"), "post_id", "author")


def profiles(spark, d):
    js = """to_json(named_struct('symbol', CASE WHEN doc_id % 2 = 0 THEN concat('S', doc_id) END, 'ipnft', named_struct('name', source, 'initialSymbol', concat('I', doc_id), 'description', CASE WHEN lang = 'en' THEN 'a  b' END,
      'researchLead', CASE WHEN doc_id % 3 = 0 THEN named_struct('name', concat('L', doc_id)) END, 'fundingAmountValue', CASE WHEN doc_id % 5 = 0 THEN '2500' END, 'fundingAmountDecimals', 2, 'fundingAmountCurrency', 'USD',
      'agreements', CASE WHEN doc_id % 4 = 0 THEN array(named_struct('type', 'X'), named_struct('type', 'Y')) END, 'createdAt', '2024', 'ipt', CASE WHEN doc_id % 7 = 0 THEN named_struct('symbol', 'T', 'markets', array(named_struct('liquidityUsd', 5))) END,
      'links', array(named_struct('homepage', concat('https://x.com/u', doc_id), 'tokenUri', 'ipfs://skip'), named_struct('homepage', 'no url', 'tokenUri', 'none')))))"""
    return docs(spark, d).selectExpr("doc_id", f"parse_json({js}) AS profile")


@query("profile_meta", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'S' ELSE 'I' END || doc_id AS symbol, source AS name, CASE WHEN doc_id % 3 = 0 THEN 'L' || doc_id ELSE 'Anonymous' END AS research_lead FROM documents")
def _(spark, d):
    return R.profile_meta(profiles(spark, d), "doc_id").select("doc_id", "symbol", "name", "research_lead")


@query("profile_facts", """SELECT doc_id, section, CASE section WHEN 'funding' THEN 'Funding amount on-chain: 25.0 USD.' WHEN 'agreements' THEN 'On-chain agreements present (2): X, Y.' WHEN 'description' THEN 'Project description (from on-chain metadata): a b' ELSE '' END AS text
  FROM documents, (VALUES ('identity'), ('description'), ('research_lead'), ('funding'), ('agreements'), ('agreements_missing'), ('tokenomics'), ('tokenomics_missing'), ('timeline')) v(section)
  WHERE CASE section WHEN 'description' THEN lang = 'en' WHEN 'research_lead' THEN doc_id % 3 = 0 WHEN 'funding' THEN doc_id % 5 = 0 WHEN 'agreements' THEN doc_id % 4 = 0 WHEN 'agreements_missing' THEN doc_id % 4 <> 0 WHEN 'tokenomics' THEN doc_id % 7 = 0 WHEN 'tokenomics_missing' THEN doc_id % 7 <> 0 ELSE TRUE END""")
def _(spark, d):
    f = R.profile_facts(profiles(spark, d), "doc_id")
    return f.select("doc_id", "section", F.when(F.col("section").isin("funding", "agreements", "description"), F.col("text")).otherwise("").alias("text"))


@query("walk_urls", "SELECT doc_id, 'homepage' AS title, 'https://nitter.net/u' || doc_id AS url, 'nitter.net' AS site_name FROM documents")
def _(spark, d):
    return R.walk_urls(profiles(spark, d), "doc_id", "profile").select("doc_id", "title", "url", "site_name")


@query("review_documents", "SELECT conv_id, count(*) AS n, max(turn) AS top FROM conversations GROUP BY conv_id")
def _(spark, d):
    c = table(spark, d, "conversations")
    cats = c.select("conv_id", F.concat(F.lit("d"), F.col("turn").cast("string")).alias("dimension"), F.col("turn").alias("score"), F.col("text").alias("rationale"))
    doc = R.review_documents(cats, c.groupBy("conv_id").agg(F.max("turn").alias("composite_score")), "conv_id")
    return doc.select("conv_id", F.size(F.json_object_keys(F.get_json_object("document", "$.categories"))).alias("n"), F.get_json_object("document", "$.composite_score").cast("bigint").alias("top"))


@query("run_manifest", "SELECT source, count(*) FILTER (doc_id % 5 <> 0) AS items, min(doc_id) FILTER (doc_id % 5 <> 0) AS first_id, max(doc_id) FILTER (doc_id % 5 <> 0) AS last_id, count(*) FILTER (doc_id % 5 = 0) AS errors, arg_min(lang, doc_id) FILTER (doc_id % 5 = 0) AS first_error FROM documents GROUP BY source")
def _(spark, d):
    return R.manifest(docs(spark, d).filter("doc_id % 5 <> 0"), docs(spark, d).filter("doc_id % 5 = 0").withColumn("reason", F.col("lang")), ["source"], "doc_id")


# --- T: batch twins -----------------------------------------------------------------------------------
_STAT = "CASE WHEN contains(line, 'Step 1 — Crawl') THEN 'crawling' WHEN contains(line, 'Step 2 —') OR contains(line, 'Step 3 —') THEN 'reviewing' END"
_CHG = f"s AS (SELECT run_id, ts, event_id, {_STAT} AS status FROM run_log WHERE {_STAT} IS NOT NULL), c AS (SELECT * FROM (SELECT *, lag(status) OVER (PARTITION BY run_id ORDER BY ts, event_id) AS p FROM s) WHERE p IS NULL OR p <> status)"


@query("status_changes", cte("run_log") + f", {_CHG} SELECT run_id, event_id, status FROM c")
def _(spark, d):
    return ST.status_changes(view(spark, d, "run_log")).select("run_id", "event_id", "status")


@query("current_status", cte("run_log") + f", {_CHG} SELECT run_id, arg_max(status, event_id) AS status, count(*) > 0 AS seen FROM c GROUP BY run_id")
def _(spark, d):
    return ST.current_status(ST.status_changes(view(spark, d, "run_log"))).select("run_id", "status", F.col("started_at").isNotNull().alias("seen"))


@query("discover_round", MAT + f""", k AS (SELECT doc_id, compound, source_type, {KEY} AS material_key FROM material), o AS (SELECT * FROM k WHERE doc_id % 3 = 0),
  f AS (SELECT * FROM k WHERE doc_id % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM o WHERE o.compound = k.compound AND o.material_key = k.material_key)),
  u AS (SELECT * FROM f QUALIFY material_key IS NULL OR row_number() OVER (PARTITION BY compound, material_key ORDER BY doc_id) = 1),
  h AS (SELECT compound, source_type, count(*) AS have FROM o GROUP BY ALL),
  r AS (SELECT u.*, coalesce(have, 0) AS have, row_number() OVER (PARTITION BY compound, source_type ORDER BY doc_id) AS rn FROM u LEFT JOIN h USING (compound, source_type))
  SELECT doc_id, material_key FROM r WHERE rn <= CASE source_type WHEN 'europe_pmc' THEN least(2, 9 - have) ELSE least(20, 200 - have) END""")
def _(spark, d):
    m = material(spark, d).withColumn("material_key", M.material_key())
    return ST.discover_round(m.filter("doc_id % 3 <> 0"), m.filter("doc_id % 3 = 0"), ["compound"], "source_type", "material_key", ["doc_id"], {"europe_pmc": (2, 9)}).select("doc_id", "material_key")


@query("round_meta", "SELECT source AS compound, doc_id % 3 AS round, lang AS source_type, count(*) AS new_rows, count(*) < CASE lang WHEN 'en' THEN 5 ELSE 2 END AS exhausted FROM documents GROUP BY source, doc_id % 3, lang")
def _(spark, d):
    r = docs(spark, d).select(F.col("source").alias("compound"), (F.col("doc_id") % 3).alias("round"), F.col("lang").alias("source_type"))
    return ST.round_meta(r, "round", ["compound"], "source_type", {"en": (5, 9)}, 2)


# --- U: a deterministic stand-in for the model ------------------------------------------------------------
def echo(answer):
    """A callable that answers from the prompt alone; what the tests use in place of a served model."""
    return lambda prompts: [answer(p) for p in prompts]


@query("model_map", "SELECT doc_id, '<' || substr(text, 1, 20) || '>' AS answer FROM documents")
def _(spark, d):
    return MO.model_map(docs(spark, d).select("doc_id", "text"), F.substring("text", 1, 20), echo(lambda x: f"<{x}>")).select("doc_id", "answer")


@query("model_verdicts", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'supported' WHEN 1 THEN 'unsupported' ELSE 'validation_error' END AS verdict, doc_id % 3 = 2 AS validation_error FROM documents")
def _(spark, d):
    p = docs(spark, d).select("doc_id", (F.col("doc_id") % 3).cast("string").alias("kind"))
    full = echo(lambda x: 'ok {"verdict": "supported", "rationale": "r", "relevancy_score": 2}' if x == "0" else "none")
    return MO.verdicts(p, full, echo(lambda x: "verdict: unsupported" if x == "1" else "?"), echo(lambda x: "because"), F.col("kind")).select("doc_id", "verdict", "validation_error")


@query("model_grades", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'strong' WHEN 1 THEN 'weak' ELSE 'unverifiable' END AS evidence_grade FROM documents")
def _(spark, d):
    p = docs(spark, d).select("doc_id", (F.col("doc_id") % 3).cast("string").alias("kind"))
    fn = echo(lambda x: '{"evidence_grade": "strong"}' if x == "0" else '{"evidence_grade": "weak"}' if x.startswith("1") and "ONLY" in x else "no")
    return MO.grade_evidence(p, F.col("kind"), fn).select("doc_id", "evidence_grade")


@query("model_lines", "SELECT doc_id AS chunk_id, 'feature' AS line_type, lang AS text FROM documents")
def _(spark, d):
    fn = echo(lambda x: '[{"line_type": "odd", "text": " ' + x + ' "}, {"line_type": "claim", "text": ""}]')
    return MO.extract_lines(docs(spark, d).select(F.col("doc_id").alias("chunk_id"), "lang"), F.col("lang"), fn).select("chunk_id", "line_type", "text")


@query("model_validation", "SELECT doc_id AS line_id, CASE WHEN doc_id % 2 = 0 THEN 'valid' ELSE 'positive' END AS verdict FROM documents")
def _(spark, d):
    ln = docs(spark, d).select(F.col("doc_id").alias("line_id"), (F.col("doc_id") % 2 == 0).alias("needs_scientific_support"), F.array(F.lit("W1")).alias("retrieved"), "lang")
    return MO.validate_lines(ln, echo(lambda x: '{"verdict": "Valid", "citations": ["W1", "W2"]}'), echo(lambda x: '{"verdict": "positive"}'), F.col("lang"), F.col("lang")).select("line_id", "verdict")


@query("model_similarity", cte("works") + " SELECT work_id, CASE WHEN work_id % 3 = 0 THEN 0.1 ELSE least(1, (work_id % 3) * 0.6e0) END::DOUBLE AS similarity FROM works")
def _(spark, d):
    w = view(spark, d, "works").select("work_id", (F.col("work_id") % 3).cast("string").alias("k"))
    return MO.score_works(w, F.col("k"), echo(lambda x: "n/a" if x == "0" else f"score {int(x) * 0.6}")).select("work_id", "similarity")


@query("model_findings", "SELECT doc_id, 'team_credibility' AS dimension, 'info' AS severity FROM documents WHERE lang = 'en'")
def _(spark, d):
    w = docs(spark, d).select("doc_id", "lang").withColumn("_p", MO.window_prompt(100, F.col("lang"), F.lit("refs")))
    fn = echo(lambda x: '{"findings": [{"dimension": "team_credibility", "severity": "odd", "observation": "o"}, {"dimension": "unknown"}]}' if x.startswith("en") else "{}")
    return MO.screen_windows(w, F.col("_p"), fn, tuple(C.DIMENSION_TAGS), ["doc_id"]).select("doc_id", "dimension", "severity")


@query("model_headings", "SELECT doc_id, CASE lang WHEN 'en' THEN 'method' ELSE 'other' END AS semantic_category FROM documents")
def _(spark, d):
    c = docs(spark, d).select("doc_id", F.upper("lang").alias("section_heading"))
    return MO.classify_headings(c, F.col("_h"), echo(lambda x: "Method" if x == "en" else "what"), ("method", "result")).select("doc_id", "semantic_category")


@query("model_payload", "WITH t AS (SELECT source, lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) <= 12) SELECT source, lang, '{\"source\":\"' || source || '\",\"lang\":\"' || lang || '\",\"units\":[' || string_agg('{\"doc_id\":' || doc_id || '}', ',' ORDER BY doc_id) || ']}' AS payload FROM t GROUP BY source, lang")
def _(spark, d):
    return MO.payload(docs(spark, d), ["source", "lang"], ["doc_id"], ["doc_id"])


@query("model_overview", cte("findings") + " SELECT finding_id, severity, CASE WHEN trim(upper(observation)) = '' THEN observation ELSE upper(observation) END AS observation FROM findings WHERE NOT regexp_matches(observation, '[ß<`]')")
def _(spark, d):
    f = view(spark, d, "findings").filter(~F.col("observation").rlike("[ß<`]"))
    return MO.overview(f, echo(str.upper), ["finding_id"], "observation").select("finding_id", "severity", "observation")


# --- R ------------------------------------------------------------------------------------------------
def _audit_inputs(spark, d):
    placed = G.triage(members(spark, d).withColumn("paper", F.col("doc_name")), "empirical", first_tags="tags")
    cats = S.evidence_scores(placed, "empirical", ("paper", "dimension"))
    f = L.clean_findings(view(spark, d, "findings"), tuple(C.DIMENSION_TAGS)).withColumn("paper", F.concat(F.lit("src"), (F.col("doc_id") % 20).cast("string")))
    w = view(spark, d, "works").withColumns({"paper": F.concat(F.lit("src"), (F.col("doc_id") % 20).cast("string")), "doi": F.concat(F.lit("10.1/"), F.col("work_id").cast("string"))})
    return cats, placed, f, w


@query("article_audit")
def _(spark, d):
    return RP.assemble(RP.article_audit("paper", *_audit_inputs(spark, d)), "paper")


@query("fit_audit")
def _(spark, d):
    # every step reads the inputs twice, so they are made once, with what a line can show: a text cut one character later is cut the same again
    cats, placed, f, w = _audit_inputs(spark, d)
    shown = placed.select("paper", "dimension", "bucket", "evidence_grade", truncate("claim", RP.AuditDetail().claim_chars + 1).alias("claim"), "claim_id")
    inputs = [cut_lineage(x) for x in (cats, shown, f, w.drop("embedding"))]
    return RP.fit_audit(lambda x: RP.article_audit("paper", *inputs, x), "paper").select("paper", "step", F.octet_length("text").alias("bytes"))


@query("dao_audit")
def _(spark, d):
    ln = cited_lines(spark, d).withColumn("project", F.col("source_path"))
    cats = ln.groupBy("project", "category").agg(F.count("*").alias("score"))
    return RP.assemble(RP.dao_audit(ln, ln, cats, "project"), "project")


@query("proposal_audit")
def _(spark, d):
    cats, _, f, w = _audit_inputs(spark, d)
    prov = docs(spark, d).groupBy(F.col("source").alias("paper")).agg(F.max("doc_id").cast("string").alias("value")).withColumn("name", F.lit("documents"))
    money = prov.select("paper", F.lit(50.0).alias("percent_funded"), F.lit(3).alias("days_remaining"))
    return RP.assemble(RP.proposal_audit("paper", prov, cats, f, w, money), "paper")


@query("compound_audit")
def _(spark, d):
    m = material(spark, d)
    tags = M.tag_counts(m, ["compound"], "risk_relevance").withColumnRenamed("risk_relevance", "tag")
    return RP.assemble(RP.compound_audit("compound", M.coverage(m, ["compound"], M.SINGLE_COVERAGE), tags, M.evidence_units(m, ["compound"], ["doc_id"])), "compound")


@query("evidence_block")
def _(spark, d):
    return RP.evidence_block(cited_lines(spark, d), ["category"], ["verdict", "line_id"])


