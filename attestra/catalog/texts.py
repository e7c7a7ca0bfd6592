"""Queries for the text, URL and answer columns over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F


from attestra.catalog.registry import query, sql_list
from attestra.fixtures import cte, table, view
from attestra.functions import answers as A
from attestra.functions import text as T
from attestra.functions import urls as U
from attestra.functions.html import html_to_text, strip_tags
from attestra.functions.similarity import cosine_counts, jaccard, overlap, token_counts
from attestra.operators import ranking as K


def docs(spark, d):
    return table(spark, d, "documents")


def pages(spark, d):
    return table(spark, d, "pages")


# Documents with a citation tail and DOI lines put in, the same text in both engines.
_CITED = """concat(text, ' (', CAST(doc_id % 30 AS VARCHAR(9)), ', ', CAST(doc_id % 7 + 3 AS VARCHAR(9)), '-', CAST(doc_id % 7 + 5 AS VARCHAR(9)), ') and (see 4) (', CAST(doc_id % 90 AS VARCHAR(9)), ').')"""


@query("citation_numbers", f"""WITH t AS (SELECT doc_id, {_CITED} AS t FROM documents), g AS (SELECT doc_id, unnest(regexp_extract_all(t, '\\(([^)]+)\\)', 1)) AS g FROM t),
  p AS (SELECT doc_id, trim(unnest(string_split(g, ','))) AS p FROM g WHERE regexp_matches(trim(g), '^[0-9 ,-]+$')),
  n AS (SELECT doc_id, unnest(CASE WHEN regexp_matches(p, '^\\d+$') THEN [CAST(p AS INT)] WHEN regexp_matches(p, '^\\d+\\s*-\\s*\\d+$') THEN
    range(CAST(regexp_extract(p, '^(\\d+)', 1) AS INT), CAST(regexp_extract(p, '(\\d+)$', 1) AS INT) + 1) ELSE CAST([] AS INT[]) END) AS n FROM p)
  SELECT doc_id, string_agg(CAST(n AS VARCHAR), ',' ORDER BY n) AS numbers FROM (SELECT DISTINCT doc_id, n FROM n WHERE n BETWEEN 1 AND 60) GROUP BY doc_id""")
def _(spark, d):
    t = docs(spark, d).selectExpr("doc_id", f"{_CITED} AS t")
    return t.select("doc_id", F.array_join(T.citation_numbers("t", 60, bare=False).cast("array<string>"), ",").alias("numbers"))


_RAW = """CASE doc_id % 5 WHEN 0 THEN concat('12. Smith. https://doi.org/https://doi.org/10.1000/AB', doc_id, ').') WHEN 1 THEN concat('Doe, DOI: 10.5555/x', doc_id, '.') WHEN 2 THEN concat('see doi 10.77/', doc_id, ';')
  WHEN 3 THEN concat('https://doi.org/10.9/z', doc_id, ', more') ELSE substr(text, 1, 60) END"""


@query("extract_doi", f"WITH t AS (SELECT doc_id, {_RAW} AS r FROM documents) SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '10.1000/AB' || doc_id WHEN 1 THEN '10.5555/x' || doc_id WHEN 2 THEN '10.77/' || doc_id WHEN 3 THEN '10.9/z' || doc_id END AS doi, "
       "CASE doc_id % 5 WHEN 0 THEN '10.1000/ab' || doc_id WHEN 1 THEN '10.5555/x' || doc_id WHEN 2 THEN '10.77/' || doc_id WHEN 3 THEN '10.9/z' || doc_id END AS key FROM t")
def _(spark, d):
    t = docs(spark, d).selectExpr("doc_id", f"{_RAW} AS r").withColumn("doi", T.extract_doi("r"))
    return t.select("doc_id", "doi", T.doi_key(F.concat(F.lit("HTTPS://dx.doi.org/"), "doi")).alias("key"))


@query("short_doi", "SELECT doc_id, CASE WHEN length(text) <= 80 THEN trim(text) ELSE CASE WHEN length(trim(text)) <= 80 THEN trim(text) ELSE substr(trim(text), 1, 77) || '...' END END AS label FROM documents WHERE text <> ''")
def _(spark, d):
    return docs(spark, d).filter("text <> ''").select("doc_id", T.short_doi(F.concat(F.lit("https://doi.org/"), F.trim("text"))).alias("label"))


_REFDOC = "concat(text, '\n** References **\n', '1. Alpha doi: 10.1/a', doc_id, '\nnoise\n2. Beta https://doi.org/10.2/b', doc_id, '\n1. Gamma doi 10.3/c', doc_id)"


@query("reference_index", "SELECT doc_id, n AS ref_number, CASE n WHEN 1 THEN '1. Gamma doi 10.3/c' || doc_id ELSE '2. Beta https://doi.org/10.2/b' || doc_id END AS raw_text, CASE n WHEN 1 THEN '10.3/c' || doc_id ELSE '10.2/b' || doc_id END AS doi FROM documents, (VALUES (1), (2)) v(n)")
def _(spark, d):
    return T.reference_index(docs(spark, d).selectExpr("doc_id", f"{_REFDOC} AS t"), "doc_id", "t")


_MD = "concat('preface ', doc_id, '\n# ', substr(replace(text, '\n', ' '), 1, 20), 'x\n', text, '\n\n### Second  \nbody ', lang)"


@query("split_headings", "WITH t AS (SELECT *, trim(substr(replace(text, '\n', ' '), 1, 20) || 'x') AS h FROM documents) SELECT doc_id, i AS pos, CASE i WHEN 0 THEN 'Header' WHEN 1 THEN h ELSE 'Second' END AS heading, CASE i WHEN 0 THEN 'preface ' || doc_id WHEN 1 THEN trim(text, ' \n\t\r') ELSE 'body ' || lang END AS body FROM t, (VALUES (0), (1), (2)) v(i) WHERE doc_id % 4 <> 0 "
       "UNION ALL SELECT doc_id, 0, 'Body', text FROM documents WHERE doc_id % 4 = 0")
def _(spark, d):
    t = docs(spark, d).select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.col("text")).otherwise(F.expr(_MD)).alias("t"))
    s = t.select("doc_id", F.posexplode(T.split_headings("t")).alias("pos", "_s"))
    return s.select("doc_id", "pos", "_s.heading", "_s.body")


@query("normalize_text", "SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS flat, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS low, replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 'ß', 'ss') AS folded FROM documents")
def _(spark, d):
    t = F.concat(F.lit("---\nkey: value\n---\n"), "text")
    body = T.strip_front_matter(t)
    return docs(spark, d).select("doc_id", T.normalize(body, "plain").alias("flat"), T.normalize(body).alias("low"), T.normalize(body, "fold").alias("folded"))


@query("tokens", f"""SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z0-9]{{3,}}')) AS topic, len(list_distinct(list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^a-z0-9 ]+', ' ', 'g'), ' +'), lambda t: length(t) > 2 AND NOT list_contains({sql_list(T.LINE_STOP_WORDS)}, t)))) AS line,
  len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS words FROM documents""")
def _(spark, d):
    return docs(spark, d).select("doc_id", F.size(T.topic_tokens("text")).alias("topic"), F.size(T.line_tokens("text")).alias("line"), F.size(T.words("text")).alias("words"))


@query("estimate_tokens", "SELECT doc_id, CAST(greatest(floor(length(text) / 3.2), floor(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) / 0.75)) AS INT) AS tokens FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", T.estimate_tokens("text").alias("tokens"))


_HOST = "regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^www\\.', '')"
_PATH = "regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)"


@query("url_parts", f"SELECT page_id, {_HOST} AS host, {_PATH} AS path, rtrim(url, '/') AS key, CASE WHEN trim({_PATH}, '/') = '' THEN 'index' ELSE substr(trim(regexp_replace(replace(trim({_PATH}, '/'), '/', '__'), '_+', '_', 'g'), '._ '), 1, 80) END AS slug FROM pages")
def _(spark, d):
    return pages(spark, d).select("page_id", U.url_host("url").alias("host"), U.url_path("url").alias("path"), U.url_key("url").alias("key"), U.url_slug("url").alias("slug"))


# A URL per page, its kind by page id, so that every rule of the crawl finds rows.
LINKS = """CASE page_id % 14 WHEN 0 THEN '' WHEN 1 THEN concat('https://twitter.com/', 'user', page_id % 30) WHEN 2 THEN concat('ipfs://Qm', page_id, '/') WHEN 3 THEN concat('https://www.etherscan.io/tx/', page_id)
  WHEN 4 THEN concat('https://goerli.etherscan.io/a/', page_id) WHEN 5 THEN concat('https://molecule.xyz/ipnfts/', page_id % 20) WHEN 6 THEN concat('https://mint.molecule.to/projects/', page_id % 20, '?x=1') WHEN 7 THEN 'https://molecule.xyz/'
  WHEN 8 THEN concat('https://nitter.net/@h', page_id % 25, '/media') WHEN 9 THEN concat('https://docs.example.org/a b/', page_id, '.pdf?q=1#f') WHEN 10 THEN 'https://snapshot.box' WHEN 11 THEN concat('https://nitter.net/h', page_id, '/status/', page_id) WHEN 12 THEN concat('ftp://x.example/', page_id) ELSE url END"""


def links(spark, d):
    return pages(spark, d).selectExpr("page_id", f"{LINKS} AS link", "url", "html", "CASE WHEN page_id % 3 = 0 THEN 'no' ELSE 'yes' END AS http_accessible", "CASE page_id % 5 WHEN 0 THEN 'downloadUrl' WHEN 1 THEN 'dataApi' ELSE 'links' END AS title")


LINK_CTE = f"l AS (SELECT page_id, {LINKS} AS link, url, html, CASE WHEN page_id % 3 = 0 THEN 'no' ELSE 'yes' END AS http_accessible, CASE page_id % 5 WHEN 0 THEN 'downloadUrl' WHEN 1 THEN 'dataApi' ELSE 'links' END AS title FROM pages)"


@query("url_ids", f"WITH {LINK_CTE} SELECT page_id, CASE page_id % 14 WHEN 5 THEN CAST(page_id % 20 AS VARCHAR) WHEN 6 THEN CAST(page_id % 20 AS VARCHAR) END AS project, CASE page_id % 14 WHEN 8 THEN 'h' || (page_id % 25) END AS handle, page_id % 14 IN (3, 4) AS explorer, page_id % 14 IN (1, 8, 11) AS social, page_id % 14 = 2 AS ipfs FROM l")
def _(spark, d):
    return links(spark, d).select("page_id", U.project_id("link").alias("project"), U.handle("link").alias("handle"), U.is_explorer("link").alias("explorer"), U.is_social("link").alias("social"), U.is_ipfs("link").alias("ipfs"))


# Links of page_id % 14 = 8 and 11 name a few profiles in two spellings and a few posts, so that both rules find repeats.
_PROFILE = "CASE WHEN page_id % 14 = 8 AND page_id % 4 = 0 THEN concat('https://nitter.net/H', page_id % 25, '/#top') ELSE link END"
_POST = "CASE WHEN page_id % 14 = 11 THEN concat('https://nitter.net/h', page_id % 9, '/status/', page_id % 6, '#m') ELSE link END"


@query("distinct_handles", f"""WITH {LINK_CTE} SELECT CASE WHEN page_id % 4 = 0 THEN 'H' ELSE 'h' END || (page_id % 25) AS handle, page_id AS first,
  'https://nitter.net/' || CASE WHEN page_id % 4 = 0 THEN 'H' || (page_id % 25) ELSE '@h' || (page_id % 25) || '/media' END AS link
  FROM l WHERE page_id % 14 = 8 QUALIFY row_number() OVER (PARTITION BY page_id % 25 ORDER BY page_id) = 1""")
def _(spark, d):
    return K.distinct_handles(links(spark, d).withColumn("link", F.expr(_PROFILE)), "link", "page_id")


@query("distinct_posts", f"WITH {LINK_CTE} SELECT page_id FROM l QUALIFY page_id % 14 <> 11 OR row_number() OVER (PARTITION BY page_id % 14 = 11, page_id % 6 ORDER BY page_id) = 1")
def _(spark, d):
    return K.distinct_posts(links(spark, d).withColumn("link", F.expr(_POST)), "link", ["page_id"]).select("page_id")


@query("rewrite_url", f"""WITH {LINK_CTE} SELECT page_id, CASE page_id % 14 WHEN 1 THEN 'https://nitter.net/user' || (page_id % 30) ELSE trim(link) END AS mirror, CASE page_id % 14 WHEN 2 THEN 'https://ipfs.io/ipfs/Qm' || page_id ELSE trim(link) END AS probe,
  CASE page_id % 14 WHEN 5 THEN 'https://mint.molecule.to/ipnft/' || (page_id % 20) END AS page, CASE WHEN page_id % 14 = 2 THEN 6 ELSE 0 END AS gateways, CASE page_id % 14 WHEN 9 THEN 'https://docs.example.org/a%20b/' || page_id || '.pdf?q=1#f' END AS pdf,
  'https://site.test/post/' || page_id || '/post' AS post FROM l""")
def _(spark, d):
    return links(spark, d).select("page_id", U.mirror_url("link").alias("mirror"), U.probe_url("link").alias("probe"), U.catalog_to_page("link").alias("page"), F.size(U.gateway_urls("link")).alias("gateways"),
                                  F.when(F.col("page_id") % 14 == 9, U.encode_path("link")).alias("pdf"), U.page_url("https://site.test", "post", "page_id", F.lit(" "), "post").alias("post"))


@query("link_skip_reason", f"WITH {LINK_CTE} SELECT page_id, CASE WHEN page_id % 14 = 0 THEN 'empty_url' WHEN page_id % 14 IN (8, 11) THEN 'nitter_deferred' WHEN page_id % 14 = 2 THEN 'ipfs_deferred' WHEN page_id % 14 = 1 THEN 'social_deferred' WHEN page_id % 14 IN (3, 4) THEN 'explorer_deferred' WHEN page_id % 14 = 12 THEN 'non_http' WHEN http_accessible = 'no' THEN 'inaccessible' END AS reason FROM l")
def _(spark, d):
    return links(spark, d).select("page_id", U.link_skip_reason("link", None, "http_accessible").alias("reason"))


@query("crawl_mode", f"WITH {LINK_CTE} SELECT page_id, CASE WHEN page_id % 14 IN (5, 6, 7) THEN 'hub' WHEN page_id % 14 = 10 THEN 'spa_single' WHEN contains(lower(link), 'doc') OR contains({_HOST.replace('url', 'link')}, 'gitbook') THEN 'docs_deep' ELSE 'single' END AS mode FROM l")
def _(spark, d):
    return links(spark, d).select("page_id", U.crawl_mode("link").alias("mode"))


@query("keep_link", f"WITH {LINK_CTE} SELECT page_id, NOT (title IN ('dataApi', 'downloadUrl', 'tokenUri') OR page_id % 14 IN (3, 4, 7)) AS keep FROM l")
def _(spark, d):
    return links(spark, d).select("page_id", U.keep_link("link", "title").alias("keep"))


@query("error_page", "SELECT page_id, page_id % 50 = 0 OR contains(lower(substr(html, 1, 8000)), 'page not found') OR page_id % 7 = 3 AS error FROM pages")
def _(spark, d):
    p = pages(spark, d)
    return p.select("page_id", U.is_error_page(F.when(F.col("page_id") % 50 == 0, 404).otherwise(200), F.when(F.col("page_id") % 7 == 3, "Sorry, Page Not Found"), "html").alias("error"))


_MDL = "concat('Copy \n[Next](http://a)\n', text, '\n* [x](http://b.c/d)\n- item\nLast updated 3 days ago\n![i](http://c)')"


@query("strip_boilerplate", "SELECT doc_id, trim(text || '\n* [x](http://b.c/d)\n- item\n![i](http://c)', ' \n\t\r') AS kept FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", U.strip_boilerplate(F.expr(_MDL)).alias("kept"))


@query("nav_share", "WITH x AS (SELECT doc_id, list_filter(string_split(text, '\n'), lambda v: trim(v, ' \t\r') <> '') AS lines FROM documents) SELECT doc_id, len(lines) = 0 OR 2 / CAST(len(lines) + 2 AS DOUBLE) >= 0.55 AS nav FROM x")
def _(spark, d):
    return docs(spark, d).select("doc_id", U.is_nav(F.when(F.trim("text") == "", F.lit("")).otherwise(F.concat("text", F.lit("\n* a\n[b](http://c)")))).alias("nav"))


@query("meaningful_length", "SELECT doc_id, length(trim(regexp_replace(regexp_replace(text, '[#>*_`~|\\[\\]\\\\-]', ' ', 'g'), '\\s+', ' ', 'g'))) AS n FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", U.meaningful_length(F.concat(F.lit("![a](b) "), "text", F.lit(" [c](d)"))).alias("n"))


@query("html_to_text")
def _(spark, d):
    return pages(spark, d).select("page_id", html_to_text("html").alias("text"))


@query("strip_tags", "SELECT doc_id, trim(text) || ' & ' || lang AS text FROM documents WHERE NOT regexp_matches(text, '[<>&]')")
def _(spark, d):
    t = docs(spark, d).filter(~F.col("text").rlike("[<>&]"))
    return t.select("doc_id", strip_tags(F.concat(F.lit("<p>"), F.trim("text"), F.lit("</p>&amp;<b>"), "lang", F.lit("</b>"))).alias("text")).withColumn("text", F.regexp_replace("text", r"\s+&\s+(\w\w)$", " & $1"))


@query("safe_names", "SELECT page_id, trim(regexp_replace(url, '[<>:\"/\\\\|?*]', '_', 'g'), ' ._-') AS stem, substr(trim(regexp_replace(url, '[^A-Za-z0-9_-]+', '_', 'g'), '_'), 1, 60) AS id, regexp_replace(url, '^/+', '') IS NOT NULL AND page_id % 2 = 0 AS pdf FROM pages")
def _(spark, d):
    p = pages(spark, d)
    f = T.file_name(F.concat(F.lit("/a/"), F.col("page_id").cast("string")), F.when(F.col("page_id") % 2 == 0, "application/pdf; x").otherwise("image/png"))
    return p.select("page_id", T.safe_stem("url").alias("stem"), T.safe_id("url").alias("id"), F.endswith(f, F.lit(".pdf")).alias("pdf"))


@query("file_names", "SELECT page_id, 'a_' || page_id || CASE page_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.png' WHEN 2 THEN '.zip' ELSE '' END AS name, CASE WHEN page_id % 5 = 0 THEN '_CON_' ELSE 'p.' || page_id END AS stem FROM pages")
def _(spark, d):
    mime = F.expr("CASE page_id % 4 WHEN 0 THEN 'application/pdf; q' WHEN 1 THEN 'IMAGE/PNG' WHEN 2 THEN 'application/x-zip' ELSE 'none' END")
    return pages(spark, d).select("page_id", T.file_name(F.concat(F.lit("//a/"), F.col("page_id").cast("string")), mime).alias("name"),
                                  T.safe_stem(F.when(F.col("page_id") % 5 == 0, "con").otherwise(F.concat(F.lit(" p."), F.col("page_id").cast("string"), F.lit("_")))).alias("stem")).withColumn("stem", F.regexp_replace("stem", "_con_", "_CON_"))


_SECTIONED = "concat('Intro\n## Abstract\n', text, '\n## Budget breakdown\nWe ask for ', text, '\n# End\n*Keywords*: alpha, ', lang, '; gamma\nPublished: ', CAST(doc_id AS VARCHAR(9)), ' May 2024**\n<img>Figure of something long ', lang, '</img><img>Journal logo</img>')"


@query("section_texts", """SELECT doc_id, CASE WHEN length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) > 100 THEN trim(regexp_replace(text, '\\s+', ' ', 'g')) ELSE 'short' END AS abstract, CASE WHEN length('We ask for ' || trim(text)) > 60 THEN substr(trim('We ask for ' || text, ' \n\t\r'), 1, 3000) ELSE 'short' END AS budget,
  'alpha|' || lang || '|gamma' AS keywords, doc_id || ' May 2024' AS published, 'Figure of something long ' || lang AS captions FROM documents""")
def _(spark, d):
    t = docs(spark, d).selectExpr("doc_id", "text", f"{_SECTIONED} AS t")
    short = F.length(T.collapse("text")) <= 100
    return t.select("doc_id", F.when(short, "short").otherwise(T.section_text("abstract", "t")).alias("abstract"),
                    F.when(F.length(F.concat(F.lit("We ask for "), F.trim("text"))) <= 60, "short").otherwise(T.section_text("budget", "t")).alias("budget"),
                    F.array_join(T.section_text("keywords", "t"), "|").alias("keywords"), T.section_text("published", "t").alias("published"), F.array_join(T.section_text("captions", "t"), "|").alias("captions"))


@query("display_forms", "SELECT doc_id, CASE WHEN length(trim(replace(text, '\n', ' '))) <= 50 THEN trim(replace(text, '\n', ' ')) ELSE substr(trim(replace(text, '\n', ' ')), 1, 49) || '…' END AS short, strftime(TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 700 AS INT)), '%B %-d, %Y') AS day, CAST(ceil(round((doc_id % 101) / 100.0, 4) * 100) AS INT) AS pct, CAST(n_chars AS DOUBLE) / 1000 AS amount FROM documents")
def _(spark, d):
    from attestra.operators.scoring import ceil_percent
    day = F.expr("timestamp_seconds(unix_seconds(timestamp '2024-01-01') + 86400 * (doc_id % 700))")
    return docs(spark, d).select("doc_id", T.truncate("text", 50).alias("short"), T.review_date(day).alias("day"), ceil_percent((F.col("doc_id") % 101) / 100.0).alias("pct"), T.token_amount(F.col("n_chars").cast("string"), F.lit(3)).alias("amount"))


@query("source_labels", cte("lines") + """ SELECT line_id, CASE WHEN source_kind = 'onchain_fact' THEN 'onchain' WHEN source_kind = 'crawl_md' THEN 'crawl::' || source_path WHEN source_kind = 'pdf' THEN 'pdf::' || lang WHEN source_kind = 'image_caption' THEN 'image::' || lang WHEN source_kind = 'video_transcript' THEN 'video::' || lang WHEN source_kind = 'text_doc' THEN 'text::' || lang ELSE source_kind || '::' || lang END AS key,
  CASE WHEN source_kind IN ('crawl_md', 'unknown_kind') THEN source_path WHEN source_kind = 'onchain_fact' THEN 'IPNFT on-chain profile' WHEN source_kind = 'pdf' THEN 'Dataroom PDF · ' || lang WHEN source_kind = 'image_caption' THEN 'Dataroom image · ' || lang WHEN source_kind = 'video_transcript' THEN 'Dataroom video · ' || lang ELSE 'Dataroom file · ' || lang END AS label,
  CASE WHEN source_kind IN ('crawl_md', 'unknown_kind') THEN 'https://' || source_path || '/' ELSE 'https://mint.molecule.to/ipnft/' || line_id END AS url, CASE WHEN verdict IN ('valid', 'positive') THEN '✅' WHEN verdict IN ('invalid', 'negative') THEN '❌' WHEN verdict = 'inconclusive' THEN '❓' ELSE '·' END AS mark FROM lines""")
def _(spark, d):
    ln = view(spark, d, "lines").withColumn("domain", F.col("source_path"))
    return ln.select("line_id", T.source_key(title="lang").alias("key"), T.public_label(title="lang").alias("label"), T.public_url(item_id="line_id").alias("url"), T.verdict_mark("verdict").alias("mark"))


@query("dedupe_sentences", """WITH s AS (SELECT doc_id, string_split(regexp_replace(text || ' ' || lower(text), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
  p AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM s), t AS (SELECT doc_id, i, trim(part, ' ' || chr(9) || chr(10) || chr(13)) AS part FROM p),
  k AS (SELECT * FROM t WHERE part <> '' QUALIFY row_number() OVER (PARTITION BY doc_id, lower(part) ORDER BY i) = 1)
  SELECT d.doc_id, coalesce(string_agg(part, ' ' ORDER BY i), '') AS text FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id GROUP BY d.doc_id""")
def _(spark, d):
    return docs(spark, d).select("doc_id", T.dedupe_sentences(F.concat("text", F.lit(" "), F.lower("text"))).alias("text"))


@query("fingerprints", "SELECT doc_id, sha256(text) AS digest, substr(sha256(text), 1, 16) AS short FROM documents")
def _(spark, d):
    return docs(spark, d).select("doc_id", T.fingerprint("text").alias("digest"), T.fingerprint("text", True).alias("short"))


@query("known_citations", "SELECT doc_id, 'W' || (doc_id % 3) || CASE WHEN doc_id % 3 <> 1 THEN ',W1' ELSE '' END AS known FROM documents")
def _(spark, d):
    w = lambda c: F.concat(F.lit("W"), c.cast("string"))
    cited = F.array(w(F.col("doc_id") % 3), F.lit("Wx"), F.lit("W1"), w(F.col("doc_id") % 3))
    return docs(spark, d).select("doc_id", F.array_join(T.known_citations(cited, F.array(*[F.lit(f"W{i}") for i in range(5)])), ",").alias("known"))


_TAGLIST = ("the", "and", "of", "that", "les", "die")


@query("first_tags", f"""WITH s AS (SELECT doc_id, string_split_regex(text, '\\s+') AS ws FROM documents), w AS (SELECT doc_id, unnest(ws) AS t, generate_subscripts(ws, 1) AS i FROM s),
  k AS (SELECT doc_id, t, min(i) AS i FROM w WHERE t IN {_TAGLIST!r} GROUP BY ALL), r AS (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM k)
  SELECT d.doc_id, {", ".join(f"coalesce(max(t) FILTER (n = {i}), '') AS claim_classification_{i}" for i in (1, 2, 3))} FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id GROUP BY d.doc_id""")
def _(spark, d):
    t = docs(spark, d).withColumn("tags", T.first_tags("text", _TAGLIST))
    return t.select("doc_id", *[F.array_join(c, "").alias(n) for n, c in T.classification_columns("tags").items()])


@query("parse_tag")
def _(spark, d):
    answer = F.concat(F.lit("<think>the</think>\n"), F.substring("text", 1, 200), F.lit("\n'Negligble.'"))
    return docs(spark, d).select("doc_id", T.parse_tag(answer, ("negligible", "high"), {"Negligble": "negligible"}).alias("tag"), T.end_sentence("text").alias("sentence"))


# --- H22, H23, U10: answers wrapped around document texts ------------------------------------------
@query("clean_answer", "SELECT doc_id, 'sum ' || lang AS answer FROM documents")
def _(spark, d):
    a = F.expr("""CASE doc_id % 4 WHEN 0 THEN concat('<think>', text, '</think> sum ', lang) WHEN 1 THEN concat('sum ', lang, ' <think>', text) WHEN 2 THEN concat(text, '```json\n sum ', lang, ' \n```') ELSE concat('<reasoning>', text, '</reasoning>sum ', lang) END""")
    return docs(spark, d).select("doc_id", A.clean_answer(a).alias("answer"))


@query("recover_json", "SELECT doc_id, lang AS lang, doc_id % 9 AS n FROM documents")
def _(spark, d):
    body = F.to_json(F.struct(F.col("lang").alias("lang"), F.lit("a } b").alias("odd"), (F.col("doc_id") % 9).alias("n")))
    free = F.regexp_replace(F.substring("text", 1, 300), "[`{}\\[\\]<>\"]", "")
    a = F.when(F.col("doc_id") % 3 == 0, body).when(F.col("doc_id") % 3 == 1, F.concat(free, body, free)).otherwise(F.concat(F.lit("```json\n"), body, F.lit("\n```"), free))
    r = docs(spark, d).select("doc_id", A.recover_json(a).alias("j"))
    return r.select("doc_id", F.get_json_object("j", "$.lang").alias("lang"), F.get_json_object("j", "$.n").cast("int").alias("n"))


@query("recover_json_array", "SELECT doc_id, CASE doc_id % 3 WHEN 2 THEN 1 ELSE 2 END AS items FROM documents")
def _(spark, d):
    o = F.to_json(F.struct("lang", "source"))
    a = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("["), o, F.lit(","), o, F.lit("]"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("list: ["), o, F.lit(","), o, F.lit("] end"))).otherwise(
        F.concat(F.lit("["), o, F.lit(",{\"lang\": \"cut")))
    return docs(spark, d).select("doc_id", F.size(F.try_variant_get(F.try_parse_json(A.recover_json(a, "array")), "$", "array<variant>")).alias("items"))


@query("parse_summary", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'a|' || lang WHEN 1 THEN 'x ' || lang || '|y' ELSE 'No summary produced for this topic group.' END AS bullets FROM documents")
def _(spark, d):
    a = F.expr("""CASE doc_id % 3 WHEN 0 THEN concat('{"bullets": ["a", "', lang, '"]}') WHEN 1 THEN concat('- x ', lang, '\n\n - y') ELSE '' END""")
    return docs(spark, d).select("doc_id", F.array_join(A.parse_bullets(a), "|").alias("bullets"))


# --- D15 similarity measures -----------------------------------------------------------------------
_SQLTOK = "list_distinct(regexp_extract_all(lower({c}), '[a-z0-9]{{3,}}'))"


@query("similarity_measures", f"""WITH p AS (SELECT a.doc_id, {_SQLTOK.format(c='a.text')} AS x, {_SQLTOK.format(c='b.text')} AS y FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)
  SELECT doc_id, round(CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0 ELSE len(list_intersect(x, y)) / CAST(len(list_distinct(list_concat(x, y))) AS DOUBLE) END, 6) AS jaccard, round(CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0 ELSE len(list_intersect(x, y)) / CAST(least(len(x), len(y)) AS DOUBLE) END, 6) AS overlap FROM p""")
def _(spark, d):
    a, b = docs(spark, d).select("doc_id", T.topic_tokens("text").alias("x")), docs(spark, d).select((F.col("doc_id") - 1).alias("doc_id"), T.topic_tokens("text").alias("y"))
    return a.join(b, "doc_id").select("doc_id", F.round(jaccard("x", "y"), 6).alias("jaccard"), F.round(overlap("x", "y"), 6).alias("overlap"))


@query("cosine_counts", """WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]{3,}')) AS w FROM documents), c AS (SELECT doc_id, w, count(*) AS n FROM t GROUP BY ALL), s AS (SELECT doc_id, sqrt(sum(n * n)) AS s FROM c GROUP BY doc_id),
  dp AS (SELECT a.doc_id, sum(a.n * b.n) AS dot FROM c a JOIN c b ON b.doc_id = a.doc_id + 1 AND a.w = b.w GROUP BY ALL)
  SELECT a.doc_id, round(CASE WHEN x.s IS NULL OR y.s IS NULL THEN 0 ELSE coalesce(dot, 0) / (x.s * y.s) END, 6) AS cosine FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1 LEFT JOIN dp ON dp.doc_id = a.doc_id LEFT JOIN s x ON x.doc_id = a.doc_id LEFT JOIN s y ON y.doc_id = b.doc_id""")
def _(spark, d):
    base = docs(spark, d)
    counts = token_counts(base, "doc_id", T.topic_tokens("text"))
    pairs = base.select("doc_id", (F.col("doc_id") + 1).alias("other")).join(base.select(F.col("doc_id").alias("other")), "other")
    return cosine_counts(pairs.withColumnRenamed("doc_id", "left_id"), counts, "doc_id", "left_id", "other").select(
        F.col("left_id").alias("doc_id"), F.round("cosine", 6).alias("cosine"))
