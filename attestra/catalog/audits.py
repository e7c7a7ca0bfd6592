"""Whole article audits and their byte limit: queries over every document, conversation and embedding, with DuckDB text of the same documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestra.catalog.registry import query
from attestra.fixtures import claims, cte, table, view
from attestra.functions.text import SPACES
from attestra.operators import audits as A
from attestra.operators import project_audits as PA

_REVIEWS = """SELECT source AS paper, source AS research_name, 'June 1, 2026' AS review_date, CAST(count(*) * 37 % 1000 AS DOUBLE) / 1000 AS composite_score, source <> 'src3' AS has_screener,
  source <> 'src7' AS has_originality, CAST(count(*) % 9 AS DOUBLE) / 8 AS originality_score, count(*) AS related_works_count, CAST(count(*) % 7 AS DOUBLE) / 8 AS avg_similarity
  FROM {documents} WHERE source IS NOT NULL GROUP BY source"""
_CATEGORIES = """SELECT doc_name AS paper, semantic_category AS dimension, CAST(count(*) % 101 AS DOUBLE) / 100 AS score, CASE semantic_category WHEN 'abstract' THEN NULL ELSE 'weighted' END AS score_method,
  count(*) AS claim_count, CASE semantic_category WHEN 'result' THEN sum(claim_id) END AS finding_count, CASE semantic_category WHEN 'other' THEN max(claim_id) END AS compared_works
  FROM {claims} GROUP BY doc_name, semantic_category"""
_CLAIMS = """SELECT doc_name AS paper, semantic_category AS dimension, claim_type AS bucket, claim_id, chunk_id, claim, nullif(section_heading, 'Findings') AS section_heading,
  nullif(evidence_grade, 'pending') AS evidence_grade, CASE WHEN claim_id % 6 = 0 THEN '[1, 2]' END AS citation_numbers FROM {claims}"""
_FINDINGS = """SELECT concat('src', CAST(doc_id % 20 AS VARCHAR(12))) AS paper, dimension, severity, CASE WHEN seq % 3 > 0 THEN concat('part ', CAST(seq % 5 AS VARCHAR(12))) END AS section,
  seq, observation, reverse(observation) AS quote FROM {findings} WHERE doc_id % 20 <> 3"""
_WORKS = """SELECT concat('src', CAST(doc_id % 20 AS VARCHAR(12))) AS paper, work_id, similarity, CASE WHEN work_id % 5 > 0 THEN 2000 + work_id % 25 END AS year,
  concat(search_term, ' | ', openalex_id) AS title, CASE WHEN work_id % 4 > 0 THEN concat('https://doi.org/10.1/', CAST(work_id AS VARCHAR(12))) END AS doi FROM {works} WHERE doc_id % 20 <> 7"""
#: Cited works j = 1, 2 of a claim: reference number, identifier, verdict, abstract, rationale.
_CITED = ("claim_id % 7 + {j}", "CASE {j} WHEN 1 THEN concat('https://doi.org/10.5/', CAST(claim_id AS VARCHAR(12))) END",
          "CASE (claim_id + {j}) % 3 WHEN 0 THEN 'partially_supports' WHEN 1 THEN ' ' END", "CASE (claim_id + {j}) % 2 WHEN 0 THEN 'abstract' ELSE ' ' END",
          "CASE WHEN (claim_id + {j}) % 4 > 0 THEN concat(paper, ' ', claim) END")
_NAMES = ("ref_number", "doi", "support_verdict", "abstract", "support_rationale")


def _inputs(spark, d):
    c = claims(spark, d)
    cited = [F.struct(*[F.expr(x.format(j=j)).alias(name) for x, name in zip(_CITED, _NAMES, strict=True)]) for j in (1, 2)]
    placed = spark.sql(_CLAIMS, claims=c).withColumn("citations", F.slice(F.array(*cited), 1, (F.col("claim_id") % 3).cast("int")))
    documents = F.concat(F.lit("- **Documents:** `"), F.col("related_works_count").cast("string"), F.lit("`"))
    compact = F.array(F.lit("## Provenance"), F.lit(""), documents, F.lit(""))
    reviews = spark.sql(_REVIEWS, documents=table(spark, d, "documents")).withColumns({
        "provenance_compact": compact, "provenance": F.concat(compact, F.array(F.lit("| Input | Rows |"), F.lit("|-------|-----:|"), F.concat(F.lit("| "), "paper", F.lit(" | all |")), F.lit("")))})
    return reviews, spark.sql(_CATEGORIES, claims=c), placed, spark.sql(_FINDINGS, findings=view(spark, d, "findings")), spark.sql(_WORKS, works=view(spark, d, "works"))


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _joined(*parts: str) -> str:
    return "concat_ws(chr(10), " + ", ".join(parts) + ")"


def _fixed(parts) -> str:
    return _joined(*[_q(p) for p in ((parts,) if isinstance(parts, str) else parts)])


def _clean(x: str) -> str:
    return f"trim(replace(coalesce({x}, ''), chr(10), ' '), {_q(SPACES)})"


def _short(x: str, size) -> str:
    """Of a text that is already clean."""
    return f"CASE WHEN length({x}) <= {size} THEN {x} ELSE substr({x}, 1, {size} - 1) || '…' END"


def _doi(x: str) -> str:
    return f"coalesce(replace({x}, 'https://doi.org/', ''), '?')"


def _cited(j: int) -> str:
    number, doi, verdict, abstract, _ = (x.format(j=j) for x in _CITED)
    label = f"coalesce(replace(nullif(trim({verdict}), ''), '_', ' '), CASE trim({abstract}) WHEN '' THEN {_q(A.NO_ABSTRACT)} ELSE {_q(A.UNGRADED)} END)"
    return f"'- [' || ({number}) || '] ' || {_doi(f'({doi})')} || ' → ' || {label} || CASE WHEN rationale AND rationale_chars > 0 AND (claim_id + {j}) % 4 > 0 THEN ' — ' || {_short('why', 'rationale_chars')} ELSE '' END"


def _oracle(steps, max_bytes: int) -> str:
    fields = ("claim_chars", "rationale_chars", "quote_chars", "observation_chars", "works", "self_reported", "screener_info", "rationale", "supported", "compact")
    rows = ", ".join(f"({i}, " + ", ".join(str(getattr(s, f)) for f in fields) + ")" for i, s in enumerate(steps))
    refs = f"CASE claim_id % 3 WHEN 1 THEN {_joined(_q('**References:**'), _q(''), _cited(1), _q(''))} WHEN 2 THEN {_joined(_q('**References:**'), _q(''), _cited(1), _cited(2), _q(''))} ELSE CASE WHEN citation_numbers IS NOT NULL THEN '*Inline citation numbers:* ' || citation_numbers || chr(10) END END"
    claim = _joined("'### ' || dimension || ' / ' || bucket || ' · chunk ' || chunk_id || ' · ' || coalesce(section_heading, '?')", "''", "'**Grade:** `' || coalesce(evidence_grade, '?') || '`  '", "''",
                    f"'> ' || {_short('said', 'claim_chars')}", "''", refs)
    finding = _joined("'- **' || dimension || '** (' || severity || ') · *' || coalesce(section, '?') || '*'", f"'  - Quote: ' || {_short('q', 'quote_chars')}", f"'  - Observation: ' || {_short('o', 'observation_chars')}", "''")
    work = "'| ' || place || ' | ' || printf('%.4f', similarity) || ' | ' || coalesce(year::VARCHAR, '?') || ' | ' || replace(" + _short("t", A.TITLE_CHARS) + ", '|', '\\|') || ' | ' || replace(" + _doi("doi") + ", '|', '\\|') || ' |'"
    title = _joined(_q(A.TITLE), "''", "'**Document:** ' || research_name || '  '", "'**Review date:** ' || review_date || '  '", "'**Composite score:** ' || printf('%.4f', composite_score) || '  '", "''", _q(A.INTRO), "''")
    prov = _joined("'## Provenance'", "''", "'- **Documents:** `' || related_works_count || '`'", "''", "CASE WHEN NOT compact THEN " + _joined("'| Input | Rows |'", "'|-------|-----:|'", "'| ' || paper || ' | all |'", "''") + " END")
    stats = "CASE WHEN has_originality THEN '**Originality score:** ' || originality_score || ' · **Related works retrieved:** ' || related_works_count || ' · **Avg similarity:** ' || avg_similarity || chr(10) END"
    body = _joined(title, prov, _fixed(A.CATEGORY_HEAD), "cat", "''", _fixed(A.GRADE_HEAD), "gr", "''", _fixed((*A.CLAIM_HEAD, *A.CLAIM_LIMITS)), f"coalesce(cl, {_fixed(A.NO_CLAIMS)})",
                   _fixed(A.SCREENER_HEAD), f"coalesce(fi, CASE WHEN has_screener THEN {_fixed(A.NO_FINDINGS)} ELSE {_fixed(A.NO_SCREENER)} END)", _fixed(A.WORKS_HEAD), stats,
                   f"coalesce({_fixed(A.WORKS_TABLE)} || chr(10) || wo, CASE WHEN has_originality THEN {_q(A.NO_WORKS)} ELSE {_q(A.NO_ORIGINALITY)} END)")
    part = lambda s, source: s.replace("{" + source + "}", source)
    return cte("claims", "findings", "works") + f""",
s(step, {', '.join(fields)}) AS (VALUES {rows}),
r AS ({part(_REVIEWS, 'documents')}),
c AS (SELECT *, {_clean('claim')} AS said, {_clean("concat(paper, ' ', claim)")} AS why FROM ({part(_CLAIMS, 'claims')})),
f AS (SELECT *, {_clean('observation')} AS o, {_clean('quote')} AS q FROM ({part(_FINDINGS, 'findings')})),
w AS (SELECT *, {_clean('title')} AS t, row_number() OVER (PARTITION BY paper ORDER BY similarity DESC, work_id) AS place FROM ({part(_WORKS, 'works')})),
cats AS (SELECT paper, string_agg('| ' || dimension || ' | ' || printf('%.4f', score) || ' | ' || coalesce(score_method, '') || ' | ' || concat_ws('; ', 'claim_count=' || claim_count, 'finding_count=' || finding_count::BIGINT, 'compared_works=' || compared_works) || ' |', chr(10) ORDER BY dimension) AS cat
  FROM ({part(_CATEGORIES, 'claims')}) GROUP BY paper),
grs AS (SELECT paper, string_agg(line, chr(10) ORDER BY dimension) AS gr FROM (SELECT paper, dimension, '- **' || dimension || ':** ' || string_agg(g || ': ' || n, '; ' ORDER BY n DESC, g) AS line
  FROM (SELECT paper, dimension, coalesce(evidence_grade, 'unknown') AS g, count(*) AS n FROM c GROUP BY paper, dimension, g) GROUP BY paper, dimension) GROUP BY paper),
cls AS (SELECT step, paper, string_agg({claim}, chr(10) ORDER BY dimension, bucket, claim_id) AS cl FROM c, s
  WHERE self_reported OR NOT (coalesce(evidence_grade, '') IN ('self_reported', 'self_reported_method') OR NOT supported AND coalesce(evidence_grade, '') IN ('strong', 'moderate')) GROUP BY ALL),
fis AS (SELECT step, paper, string_agg({finding}, chr(10) ORDER BY dimension, severity, coalesce(section, ''), seq) AS fi FROM f, s WHERE screener_info OR severity <> 'info' GROUP BY ALL),
wos AS (SELECT step, paper, string_agg({work}, chr(10) ORDER BY place) AS wo FROM w, s WHERE place <= works GROUP BY ALL),
t AS (SELECT paper, step, {body} || chr(10) AS text FROM r CROSS JOIN s LEFT JOIN cats USING (paper) LEFT JOIN grs USING (paper) LEFT JOIN cls USING (step, paper) LEFT JOIN fis USING (step, paper) LEFT JOIN wos USING (step, paper))
SELECT paper, step::INTEGER AS step, strlen(text) AS bytes, text FROM t QUALIFY row_number() OVER (PARTITION BY paper ORDER BY CASE WHEN strlen(text) <= {max_bytes} OR step = {len(steps) - 1} THEN step ELSE 1000 END) = 1"""


@query("article_document", _oracle([A.Detail()], 120 * 1024))
def _(spark, d):
    return A.article_document("paper", *_inputs(spark, d))


@query("article_document_fitted", _oracle(A.attempts(), 24 * 1024))
def _(spark, d):
    return A.article_document("paper", *_inputs(spark, d), A.attempts(), 24 * 1024)


# --- R3: projects are sources of the driver documents; every document is a chunk and a line ------------------------
_PROJECTS = """SELECT source AS project, source AS name, CASE source WHEN 'src1' THEN NULL ELSE concat('Lab ', source) END AS organization, CASE source WHEN 'src2' THEN NULL ELSE concat('7_', source) END AS item_id,
  'June 1, 2026' AS review_date, count(*) % 101 AS composite_score, source <> 'src4' AS has_token, CAST(count(*) % 2 AS INT) AS markets, CASE source WHEN 'src5' THEN 'Anon' ELSE 'A. Person' END AS research_lead
  FROM {documents} WHERE source IS NOT NULL GROUP BY source"""
_PROJECT_LINES = """SELECT source_path AS project, line_id AS seq, CAST(line_id AS VARCHAR(20)) AS line_id, line_id AS chunk_id, source_kind, CASE WHEN lang IN ('en', 'fr') THEN concat(lang, '.org') END AS domain,
  CASE WHEN lang <> 'en' THEN concat(lang, ' file') END AS doc_title, nullif(verdict, 'neutral') AS verdict, text, CASE line_id % 3 WHEN 0 THEN text WHEN 1 THEN concat(' ', source_path, ' said ') END AS verbatim_quote,
  CASE WHEN line_id % 4 > 0 THEN concat(' of ', lang) END AS rationale, category, line_type, CAST(line_id % 8 AS DOUBLE) / 8 AS weight, CASE WHEN line_id % 5 > 0 THEN CAST(line_id % 7 AS DOUBLE) / 8 END AS effective_weight,
  line_id % 3 AS cluster_size FROM {lines}"""
#: Cited work j = 1, 2 of a line and what is known of it.
_PAPER = "concat('W', CAST(seq * {j} % 40 AS VARCHAR(20)))"
_KNOWN = (("openalex_id", _PAPER), ("title", "CASE WHEN seq % 6 > 0 THEN concat('Paper ', CAST(seq AS VARCHAR(20))) END"), ("year", "CAST(CASE WHEN seq % 5 > 0 THEN 2000 + seq % 20 END AS INT)"), ("cited_by_count", "CAST(seq % 9 AS INT)"))


def _project_oracle(per_source: int, page: str) -> str:
    part = lambda s, source: s.replace("{" + source + "}", source)
    listed = "[" + ", ".join(_q(v) for v in PA.LISTED) + "]"
    two = lambda x: f"printf('%.2f', coalesce({x}, 0)::DOUBLE)"
    prefix = "CASE source_kind WHEN 'image_caption' THEN 'image' WHEN 'video_transcript' THEN 'video' WHEN 'text_doc' THEN 'text' ELSE source_kind END"
    source = f"CASE WHEN source_kind = 'onchain_fact' THEN 'onchain' WHEN source_kind = 'crawl_md' AND domain IS NOT NULL THEN 'crawl::' || domain ELSE {prefix} || '::' || coalesce(doc_title, '') END"
    item = f"{_q(page)} || coalesce('ipnft/' || item_id, '')"
    label = ("CASE WHEN kind = 'crawl_md' AND domain IS NOT NULL THEN domain WHEN kind = 'onchain_fact' THEN 'IPNFT on-chain profile' WHEN kind = 'pdf' THEN 'Dataroom PDF · ' || coalesce(title, 'PDF') "
             "WHEN kind = 'image_caption' THEN 'Dataroom image · ' || coalesce(title, 'image') WHEN kind = 'video_transcript' THEN 'Dataroom video · ' || coalesce(title, 'video') "
             "WHEN kind = 'text_doc' THEN 'Dataroom file · ' || coalesce(title, '') WHEN domain IS NOT NULL THEN domain ELSE coalesce(title, kind) END")
    url = f"CASE WHEN domain IS NOT NULL AND kind NOT IN ('onchain_fact', 'pdf', 'image_caption', 'video_transcript', 'text_doc') THEN 'https://' || domain || '/' ELSE {item} END"
    place = "CASE " + " ".join(f"WHEN starts_with(source, {_q(p)}) THEN {i}" for i, p in enumerate(PA.SOURCE_ORDER)) + f" ELSE {len(PA.SOURCE_ORDER)} END"
    trimmed = lambda x: f"trim(coalesce({x}, ''), {_q(SPACES)})"
    mark = "CASE WHEN verdict IN ('valid', 'positive') THEN '✅' WHEN verdict = 'inconclusive' THEN '❓' ELSE '❌' END"
    line = _joined(f"'- ' || {mark} || ' **' || verdict || '** · `#' || line_id || '` · _' || replace(category, '_', ' ') || ' · ' || line_type || ' · weight ' || {two('weight')} || ' → eff ' || {two('coalesce(effective_weight, weight)')}"
                   " || CASE WHEN cluster_size > 1 THEN ' · cluster ×' || cluster_size ELSE '' END || '_ — ' || said", "CASE WHEN quote <> '' AND lower(quote) <> lower(said) THEN '    > ' || quote END",
                   "CASE WHEN len(citations) > 0 THEN '    Supporting literature: ' || list_aggregate(list_transform(citations, lambda w: '[' || w || '](https://openalex.org/' || w || ')'), 'string_agg', ', ') END",
                   "CASE WHEN why <> '' THEN '    *Validator note:* ' || why END")
    head = _joined(f"'### ' || {label}", "''", f"'**Link:** [' || {url} || '](' || {url} || ')  '", "'**Chunks read:** ' || chunks || ' · **Lines extracted:** ' || n || ' · **Verdicts:** ' || verdicts", "''",
                   f"CASE WHEN listed = 0 THEN {_q(PA.NO_VERDICTS)} || chr(10) ELSE shown || chr(10) || CASE WHEN listed > {per_source} THEN '- _… ' || (listed - {per_source}) || ' additional scored line(s) omitted._' || chr(10) ELSE '' END END")
    top = _joined("'# Evidence audit · ' || name", "''", "'**Organization:** ' || coalesce(organization, 'Unknown') || '  '", f"CASE WHEN item_id IS NOT NULL THEN '**IPNFT page:** [' || {item} || '](' || {item} || ')  ' END",
                  "'**Review date:** ' || review_date || '  '", "'**Composite score:** ' || composite_score || ' / 100  '", "''", _fixed(PA.INTRO), "''", "'---'", "''", "'## At a glance'", "''",
                  "'- Sources reviewed: **' || sources || '**'", "'- Lines extracted from those sources: **' || taken || '**'",
                  "'- Lines that produced a clear verdict: **' || (good + bad) || '** (' || good || ' favorable, ' || bad || ' unfavorable)'", "'- Lines whose science could not be confirmed: **' || unsure || '**'",
                  "''", "'---'", "''", "'## Category scores'", "''", _fixed(PA.CATEGORY_TABLE))
    gaps = {"agreements": "len(agreements) = 0", "development": "len(agreements) > 0 AND NOT list_contains(agreements, 'Development Agreement')", "token": "NOT has_token", "markets": "has_token AND markets = 0",
            "lead": "research_lead = 'Anon'", "pdf": "NOT pdf", "crawl": "NOT crawl", "video": "NOT video"}
    lacks = "nullif(" + _joined(*[f"CASE WHEN {gaps[k]} THEN {_q('- ' + said)} END" for k, said in PA.GAPS.items()]) + ", '')"
    body = _joined(top, "cat", "''", _fixed(PA.SCORING), "''", "'---'", "''", "'## Sources reviewed'", "''", _fixed(PA.SOURCES), "''", "src", "'---'", "''", "'## Scientific literature consulted'", "''",
                   f"coalesce({_fixed((*PA.LITERATURE, '', *PA.WORK_TABLE))} || chr(10) || lit, {_q(PA.NO_CITATIONS)})", "''", "'---'", "''", "'## What''s missing'", "''", f"coalesce({lacks}, {_q(PA.NO_GAPS)})", "''", "'---'", "''",
                   "'*Generated by the review pipeline.*'", "''")
    work = "'| [' || substr(coalesce(title, '(unknown)'), 1, 160) || '](https://openalex.org/' || work || ') | ' || coalesce(year::VARCHAR, '—') || ' | ' || coalesce(cited_by_count::VARCHAR, '—') || ' | ' || refs || ' |'"
    known = ", ".join(f"{x.format(j=1)} AS {name}" for name, x in _KNOWN)
    return cte("lines") + f""",
r AS (SELECT *, CASE name WHEN 'src6' THEN CAST([] AS VARCHAR[]) WHEN 'src7' THEN ['Assignment Agreement'] ELSE ['Assignment Agreement', 'Development Agreement'] END AS agreements FROM ({part(_PROJECTS, 'documents')})),
l AS (SELECT *, {source} AS source, {trimmed('text')} AS said, {trimmed('verbatim_quote')} AS quote, {trimmed('rationale')} AS why, list_position({listed}, verdict) AS place,
  list_slice([{_PAPER.format(j=1)}, {_PAPER.format(j=3)}], 1, seq % 3) AS citations FROM ({part(_PROJECT_LINES, 'lines')})),
cats AS (SELECT project, string_agg('| ' || category || ' | ' || pct || ' | ' || {two('a')} || ' / ' || {two('b')} || ' | ' || g || ' / ' || s || ' | ' || n || ' | ' || c || ' |', chr(10) ORDER BY category) AS cat FROM (
  SELECT project, category, count(*) % 101 AS pct, sum(weight) AS a, sum(coalesce(effective_weight, weight)) AS b, count(*) FILTER (verdict IN ('valid', 'positive')) AS g, count(verdict) AS s, count(*) AS n, count(DISTINCT cluster_size) AS c
  FROM l GROUP BY project, category) GROUP BY project),
tops AS (SELECT project, source, string_agg({line}, chr(10) ORDER BY spot) AS shown FROM (SELECT *, row_number() OVER (PARTITION BY project, source ORDER BY place, seq) AS spot FROM l WHERE place > 0) WHERE spot <= {per_source} GROUP BY ALL),
vs AS (SELECT project, source, string_agg(v || '=' || m, ', ' ORDER BY v) AS verdicts FROM (SELECT project, source, coalesce(verdict, 'neutral') AS v, count(*) AS m FROM l GROUP BY ALL) GROUP BY ALL),
ss AS (SELECT project, source, count(*) AS chunks, count(*) AS n, count(*) FILTER (place > 0) AS listed, arg_min(source_kind, seq) AS kind, arg_min({{'d': domain, 't': doc_title}}, seq) AS sample FROM l GROUP BY ALL),
srcs AS (SELECT project, string_agg({head}, chr(10) ORDER BY {place}, source) AS src FROM (SELECT *, sample.d AS domain, sample.t AS title FROM ss) JOIN vs USING (project, source) LEFT JOIN tops USING (project, source) JOIN r USING (project) GROUP BY project),
tot AS (SELECT project, count(DISTINCT source) AS sources, count(*) AS taken, count(*) FILTER (verdict IN ('valid', 'positive')) AS good, count(*) FILTER (verdict IN ('invalid', 'negative')) AS bad, count(*) FILTER (verdict = 'inconclusive') AS unsure,
  bool_or(source_kind = 'pdf') AS pdf, bool_or(source_kind = 'crawl_md') AS crawl, bool_or(source_kind = 'video_transcript') AS video FROM l GROUP BY project),
k AS (SELECT project, seq, {known} FROM l QUALIFY row_number() OVER (PARTITION BY project, openalex_id ORDER BY seq) = 1),
refs AS (SELECT project, work, string_agg('#' || line_id, ', ' ORDER BY seq, pos) AS refs FROM (SELECT project, seq, line_id, unnest(citations) AS work, generate_subscripts(citations, 1) AS pos FROM l) GROUP BY ALL),
lits AS (SELECT project, string_agg({work}, chr(10) ORDER BY work) AS lit FROM refs LEFT JOIN (SELECT project, openalex_id AS work, title, year, cited_by_count FROM k) USING (project, work) GROUP BY project),
t AS (SELECT project, {body} AS text FROM r LEFT JOIN cats USING (project) LEFT JOIN srcs USING (project) LEFT JOIN tot USING (project) LEFT JOIN lits USING (project))
SELECT project, strlen(text) AS bytes, text FROM t"""


@query("project_document", _project_oracle(12, "https://example.org/"))
def _(spark, d):
    agreements = F.when(F.col("name") == "src6", F.array().cast("array<string>")).when(F.col("name") == "src7", F.array(F.lit("Assignment Agreement"))).otherwise(F.array(F.lit("Assignment Agreement"), F.lit("Development Agreement")))
    projects = spark.sql(_PROJECTS, documents=table(spark, d, "documents")).withColumn("agreements", agreements)
    work = F.struct(*[F.expr(x.format(j=1)).alias(name) for name, x in _KNOWN])
    lines = spark.sql(_PROJECT_LINES, lines=view(spark, d, "lines")).withColumns({
        "citations": F.slice(F.array(F.expr(_PAPER.format(j=1)), F.expr(_PAPER.format(j=3))), F.lit(1), (F.col("seq") % 3).cast("int")), "retrieved_works": F.array(work)})
    own = F.coalesce("effective_weight", "weight")
    categories = lines.groupBy("project", "category").agg(
        (F.count("*") % 101).alias("score_pct"), F.sum("weight").alias("numerator"), F.sum(own).alias("denominator"), F.count_if(F.col("verdict").isin("valid", "positive")).alias("raw_numerator"),
        F.count("verdict").alias("raw_denominator"), F.count("*").alias("line_count"), F.count_distinct("cluster_size").alias("cluster_count")).withColumn("seq", F.lit(0))
    return PA.project_document("project", projects, categories, lines, lines.select("project"), lines)
