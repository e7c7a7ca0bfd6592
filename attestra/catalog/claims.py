"""Queries over the claims view: gates, triage, dimension and evidence scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestra import config as C
from attestra.catalog.registry import query, sql_list
from attestra.fixtures import FIXTURE_TAGS, claims, cte, table, view
from attestra.operators import gates as G
from attestra.operators import scoring as S


def sql_case(pairs, default="NULL"):
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lookup_sql(mapping: dict, col: str, default: str = "NULL") -> str:
    body = " ".join(f"WHEN {q(k)} THEN {q(v) if isinstance(v, str) else v}" for k, v in mapping.items())
    return f"CASE {col} {body} ELSE {default} END"


# --- SQL twins of the gate expressions, written from the same parameters --------------------------
LOW = "coalesce(relevancy_score < 0.3, FALSE)"
NOISE = sql_case([("claim_type = 'None'", "'claim_type_none'"), ("len(tags) = 0", "'empty_claim_classification_1'"), (LOW, "'low_relevancy'")])
CAPTION = ("(contains(lower(section_heading), 'figure') OR contains(lower(section_heading), 'table') OR "
           "starts_with(lower(trim(claim)), 'figure') OR starts_with(lower(trim(claim)), 'table') OR starts_with(lower(trim(claim)), 'in all '))")
EXPECT = "(" + " OR ".join(f"contains(lower(claim), {q(p)})" for p in C.EXPECTATION_PHRASES) + ")"
BOILER = "(semantic_category = 'method' AND coalesce(relevancy_score < 0.5, FALSE))"


def bucket_sql(route: str) -> str:
    out = []
    for r in C.ROUTES[route].rules:
        cond = "claim_type IN (" + ", ".join(q(t) for t in r.claim_types) + ")"
        if r.any_tags:
            cond += f" AND list_has_any(tags, {sql_list(r.any_tags)})"
        if r.only_tag:
            cond += f" AND len(tags) = 1 AND list_contains(tags, {q(r.only_tag)})"
        out.append((cond, q(r.bucket)))
    return sql_case(out)


def placed_sql(route: str) -> str:
    quality = C.ROUTES[route].quality_gates
    gates = [(f"({NOISE}) IS NOT NULL", "'noise'")]
    if quality:
        gates.append((BOILER, "'boilerplate_method'"))
    gates.append((CAPTION, "'noise'"))
    if quality:
        gates.append((EXPECT, "'noise'"))
    return sql_case(gates, f"coalesce({bucket_sql(route)}, 'noise')")


DIMENSIONED = (f"members AS (SELECT DISTINCT c.*, dimension FROM (SELECT *, unnest(tags) AS tag FROM claims) c "
               f"JOIN (SELECT * FROM (VALUES {', '.join(f'({q(t)}, {q(d)})' for t, d in C.TAG_INDEX.items())}) AS t(map_tag, dimension)) m ON c.tag = m.map_tag)")
DIMENSIONED = DIMENSIONED.replace("SELECT DISTINCT c.*, dimension", "SELECT DISTINCT ON (claim_id, dimension) c.*, dimension")
ARGS = dict(first_tags="tags")


def members(spark, d):
    return S.claims_by_dimension(G.drop_placeholders(claims(spark, d)))


# --- P: gates ------------------------------------------------------------------------------------
@query("noise_reason", cte("claims") + f" SELECT claim_id, {NOISE} AS reason FROM claims")
def _(spark, d):
    return claims(spark, d).select("claim_id", G.noise_reason(first_tags="tags").alias("reason"))


@query("caption_gate", cte("claims") + f" SELECT claim_id, {CAPTION} AS is_caption FROM claims")
def _(spark, d):
    return claims(spark, d).select("claim_id", G.is_caption().alias("is_caption"))


@query("expectation_gate", "SELECT doc_id, (" + " OR ".join(f"contains(lower(text), {q(p)})" for p in ("is the", "are on", "should show")) + ") AS expected FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", G.is_expectation("text", ("is the", "are on", "should show")).alias("expected"))


@query("boilerplate_gate", cte("claims") + f" SELECT claim_id, {BOILER} AS boilerplate FROM claims")
def _(spark, d):
    return claims(spark, d).select("claim_id", G.is_boilerplate().alias("boilerplate"))


for _route in C.ROUTES:
    @query(f"bucket_{_route}", cte("claims") + f" SELECT claim_id, {bucket_sql(_route)} AS bucket FROM claims")
    def _(spark, d, route=_route):
        return claims(spark, d).select("claim_id", G.bucket(route).alias("bucket"))

    @query(f"triage_{_route}", cte("claims") + f", {DIMENSIONED} SELECT claim_id, dimension, {placed_sql(_route)} AS bucket FROM members")
    def _(spark, d, route=_route):
        return G.triage(members(spark, d), route, **ARGS).select("claim_id", "dimension", "bucket")

    @query(f"keep_buckets_{_route}", cte("claims") + f", placed AS (SELECT claim_id, {placed_sql(_route)} AS bucket FROM claims) "
           f"SELECT bucket, count(*) AS claims FROM placed WHERE bucket IN ({', '.join(q(b) for b in C.ROUTES[_route].keep_buckets)}) GROUP BY bucket")
    def _(spark, d, route=_route):
        return G.keep_buckets(G.triage(claims(spark, d), route, **ARGS), route).groupBy("bucket").agg(F.count("*").alias("claims"))

    @query(f"triage_stats_{_route}", cte("claims") + f", {DIMENSIONED}, placed AS (SELECT dimension, {placed_sql(_route)} AS bucket FROM members), "
           "st AS (SELECT dimension, count(*) AS total, " + ", ".join(
               f"count(*) FILTER (bucket = {q(b)}) AS {b}" for b in
               C.ROUTES[_route].keep_buckets + (("boilerplate_method",) if C.ROUTES[_route].quality_gates else ()) + ("noise",)) +
           " FROM placed GROUP BY ROLLUP(dimension)) SELECT * FROM st")
    def _(spark, d, route=_route):
        return S.triage_stats(G.triage(members(spark, d), route, **ARGS), route)

    @query(f"evidence_scores_{_route}", cte("claims") + f", {DIMENSIONED}, w AS (SELECT dimension, coalesce({lookup_sql(C.ROUTES[_route].grade_weights, 'evidence_grade')}, 0.3) AS ew, "
           "coalesce(nullif(relevancy_score, 0), 0.5) AS rel, " + (f"evidence_grade NOT IN ({', '.join(q(g) for g in C.ROUTES[_route].excluded_grades)})" if C.ROUTES[_route].excluded_grades else "TRUE") +
           " AS counted FROM members) SELECT dimension, count(*) AS claim_count, coalesce(round(sum(ew*rel) FILTER (counted) / nullif(sum(rel) FILTER (counted), 0), 4), 0.5) AS score FROM w GROUP BY dimension")
    def _(spark, d, route=_route):
        return S.evidence_scores(members(spark, d), route)


@query("triage_unknown_tags", cte("claims") + f", t AS (SELECT unnest(tags) AS tag FROM claims) SELECT tag, count(*) AS claims FROM t WHERE NOT list_contains({sql_list(C.TAG_INDEX)}, tag) GROUP BY tag")
def _(spark, d):
    return G.unknown_tags(claims(spark, d), list(C.TAG_INDEX))


@query("placeholder_filter", "SELECT conv_id, turn FROM conversations WHERE trim(text) <> '' AND rtrim(lower(trim(text)), '.') NOT IN ('no scientific claims identified in the text', 'no scientific claims identified')")
def _(spark, d):
    return G.drop_placeholders(table(spark, d, "conversations"), "text").select("conv_id", "turn")


@query("valid_relevancy", "SELECT event_id, CASE WHEN value BETWEEN 0 AND 1 THEN value END AS relevancy FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", G.valid_relevancy("value").alias("relevancy"))


@query("relevancy_label", cte("claims") + " SELECT claim_id, CASE WHEN relevancy_score IS NULL THEN 'relevancy unknown' WHEN relevancy_score < 0.2 THEN 'low relevancy' "
       "WHEN relevancy_score < 0.4 THEN 'slightly relevant' WHEN relevancy_score < 0.6 THEN 'moderately relevant' WHEN relevancy_score < 0.8 THEN 'very relevant' ELSE 'extremely relevant' END AS label FROM claims")
def _(spark, d):
    return claims(spark, d).select("claim_id", G.relevancy_label().alias("label"))


def section_sql(route):
    hints = C.PROTOCOL_SECTION_HINTS if route == "protocol" else C.SECTION_HINTS
    pairs = [("semantic_category NOT IN ('', 'other')", "semantic_category")]
    pairs += [("(" + " OR ".join(f"contains(lower(section_heading), {q(w)})" for w in words) + ")", q(n)) for n, words in hints.items()]
    return sql_case(pairs, "'other'")


for _route in ("empirical", "protocol"):
    @query(f"section_class_{_route}", cte("claims") + f" SELECT claim_id, {section_sql(_route)} AS section FROM claims")
    def _(spark, d, route=_route):
        return claims(spark, d).select("claim_id", G.section_class(route).alias("section"))

_SEC = f"s AS (SELECT *, {section_sql('empirical')} AS section, {section_sql('protocol')} AS protocol_section, len(tags) AS n_citations0, claim_id % 3 AS n_citations, claim_id % 2 AS n_usable FROM claims)"
FIND = (f"(section IN ('abstract','result','discussion') AND (claim_type = '' OR claim_type IN ({', '.join(q(t) for t in C.SELF_REPORTED_TYPES)})) AND "
        f"CASE WHEN len(tags) > 0 THEN list_has_any(tags, {sql_list(C.SELF_REPORTED_TAGS)}) ELSE claim_type IN ({', '.join(q(t) for t in C.SELF_REPORTED_TYPES)}) END)")
METH = "(section = 'method' OR (section IN ('result','discussion') AND list_contains(tags, 'Methodological')))"


@query("self_reported", cte("claims") + f", {_SEC} SELECT claim_id, {FIND} AS finding, {METH} AS method FROM s")
def _(spark, d):
    sec = G.section_class("empirical")
    return claims(spark, d).select("claim_id", G.is_self_reported(sec).alias("finding"), G.is_self_reported_method(sec).alias("method"))


REGRADE = (f"CASE WHEN evidence_grade IN ('strong','moderate') AND (protocol_section = 'method' OR list_has_any(tags, {sql_list(C.PROTOCOL_DESIGN_TAGS)})) "
           "THEN CASE WHEN list_contains(tags, 'Methodological') THEN 'established_method' ELSE 'design_precedent' END ELSE evidence_grade END")
_GRADES = {
    "grade_skip_empirical": ("empirical", "skip", sql_case([(f"n_citations = 0 AND {FIND}", "'self_reported'"), (f"n_citations = 0 AND {METH}", "'self_reported_method'")], "'pending'")),
    "grade_skip_protocol": ("protocol", "skip", "CASE WHEN n_citations = 0 THEN 'unreferenced' ELSE 'pending' END"),
    "grade_full_empirical": ("empirical", "grade", sql_case([
        (f"n_citations = 0 AND {FIND}", "'self_reported'"), (f"n_citations = 0 AND {METH}", "'self_reported_method'"), ("n_citations = 0", "'unreferenced'"),
        ("n_usable = 0", "'unverifiable'"), (f"evidence_grade IN ('unsupported','unreferenced') AND {METH}", "'self_reported_method'"),
        (f"evidence_grade IN ('unsupported','unreferenced') AND {FIND}", "'self_reported'")], "evidence_grade")),
    "grade_full_protocol": ("protocol", "grade", sql_case([("n_citations = 0", "'unreferenced'"), ("n_usable = 0", "'unverifiable'")], REGRADE)),
    "grade_full_theoretical": ("theoretical", "grade", sql_case([("n_citations = 0", "'unreferenced'"), ("n_usable = 0", "'unverifiable'")], "evidence_grade")),
}
for _name, (_r, _m, _sql) in _GRADES.items():
    @query(f"evidence_{_name}", cte("claims") + f", {_SEC} SELECT claim_id, {_sql} AS grade FROM s")
    def _(spark, d, r=_r, m=_m):
        df = claims(spark, d).withColumn("n_citations", F.col("claim_id") % 3).withColumn("n_usable", F.col("claim_id") % 2)
        return df.select("claim_id", G.evidence_grade(r, m, n_citations="n_citations", grade="evidence_grade").alias("grade"))


@query("protocol_regrade", cte("claims") + f", {_SEC} SELECT claim_id, {REGRADE} AS grade FROM s")
def _(spark, d):
    return claims(spark, d).select("claim_id", G.protocol_regrade("evidence_grade", G.section_class("protocol")).alias("grade"))


@query("unreferenced_summary", cte("claims") + f" SELECT claim_id, CASE WHEN claim_type = 'Fact' AND list_has_any(tags, {sql_list(C.EMPIRICAL_UNREFERENCED_TAGS)}) THEN 'Empirical claim with no cited references.' ELSE 'No inline citations in source chunk.' END AS summary FROM claims")
def _(spark, d):
    return claims(spark, d).select("claim_id", G.unreferenced_summary().alias("summary"))


TEMPLATE = "In {doc_name}, section {section_heading} states: {claim} It is {verdict}, {relevancy_label}, grade {evidence_grade}. {rationale} {evidence_summary}"


@query("claim_narrative", cte("claims") + """ SELECT claim_id, 'In ' || doc_name || ', section ' || section_heading || ' states: ' || claim || ' It is ' || replace(verdict, '_', ' ') || ', ' ||
  CASE WHEN relevancy_score IS NULL THEN 'relevancy unknown' WHEN relevancy_score < 0.2 THEN 'low relevancy' WHEN relevancy_score < 0.4 THEN 'slightly relevant' WHEN relevancy_score < 0.6 THEN 'moderately relevant' WHEN relevancy_score < 0.8 THEN 'very relevant' ELSE 'extremely relevant' END ||
  ', grade ' || replace(evidence_grade, '_', ' ') || '. no rationale recorded. from ' || claim_type || '.' AS narrative FROM claims""")
def _(spark, d):
    df = claims(spark, d).select("*", F.lit("").alias("rationale"), F.concat(F.lit("from "), "claim_type").alias("evidence_summary"))
    return df.select("claim_id", G.claim_narrative(TEMPLATE).alias("narrative"))


# --- J-1 and A: dimension scores ------------------------------------------------------------------
@query("claims_by_dimension", cte("claims") + f", {DIMENSIONED} SELECT claim_id, dimension FROM members")
def _(spark, d):
    return members(spark, d).select("claim_id", "dimension")


DIM_SCORES = cte("claims") + f""", {DIMENSIONED}, a AS (SELECT dimension, count(*) AS members, count(*) FILTER (verdict = 'supported') AS supported,
  count(*) FILTER (verdict = 'unsupported') AS unsupported, avg(relevancy_score) AS mr FROM members GROUP BY dimension)
  SELECT dimension, members, supported, unsupported, round(mr, 6) AS mean_relevancy,
  CASE WHEN supported + unsupported > 0 THEN round(greatest(0, least(1, (supported / (supported + unsupported) * coalesce(sqrt(mr), 1)) * (members / (members + 5.0)) + 0.5 * (1 - members / (members + 5.0)))), 4) END AS score FROM a"""


@query("dimension_scores", DIM_SCORES)
def dimension_scores(spark, d):
    return S.dimension_scores(members(spark, d))


@query("dominance_flag", cte("claims") + f", {DIMENSIONED}, p AS (SELECT {placed_sql('empirical')} AS b FROM members), a AS (SELECT count(*) FILTER (b='empirical') AS empirical, count(*) FILTER (b='contextual') AS contextual, count(*) FILTER (b='aspirational') AS aspirational FROM p) "
       "SELECT *, (empirical + contextual + aspirational >= 5) AND (contextual + aspirational > empirical) AS dominated FROM a")
def _(spark, d):
    return S.dominance_flag(G.triage(members(spark, d), "empirical", **ARGS))


@query("grade_counts", cte("claims") + f", {DIMENSIONED} SELECT dimension, evidence_grade AS grade, count(*) AS claims FROM members GROUP BY ALL")
def _(spark, d):
    return S.grade_counts(members(spark, d))


@query("grade_counts_by_bucket", cte("claims") + f", {DIMENSIONED}, p AS (SELECT *, {placed_sql('empirical')} AS bucket FROM members) SELECT dimension, bucket, evidence_grade AS grade, count(*) AS claims FROM p GROUP BY ALL")
def _(spark, d):
    return S.grade_counts(G.triage(members(spark, d), "empirical", **ARGS), ("dimension", "bucket"))


@query("grade_rollup", cte("claims") + f", {DIMENSIONED} SELECT dimension, count(*) FILTER (evidence_grade IN ('strong','moderate')) AS supported_claims, count(*) FILTER (evidence_grade IN ('self_reported','self_reported_method')) AS self_reported_claims, count(*) FILTER (evidence_grade IN ('unsupported','unreferenced')) AS unsupported_claims FROM members GROUP BY dimension")
def _(spark, d):
    return S.grade_rollup(members(spark, d))


_FIX = "f AS (SELECT *, CASE WHEN severity IN ('red_flag','concern','info') THEN severity ELSE 'info' END AS sev FROM findings)"
_PEN = "CASE WHEN dimension IN ('team_credibility','financial_integrity') THEN CASE sev WHEN 'red_flag' THEN -0.20e0 WHEN 'concern' THEN -0.10 ELSE 0 END ELSE CASE sev WHEN 'red_flag' THEN -0.15 WHEN 'concern' THEN -0.08 ELSE 0 END END"


@query("rubric_scores_articles", cte("findings") + f", {_FIX} SELECT doc_id, dimension, count(*) AS finding_count, round(greatest(0.1e0, 0.7e0 + sum({_PEN})), 4) AS score FROM f GROUP BY ALL")
def _(spark, d):
    return S.rubric_scores(view(spark, d, "findings"))


@query("rubric_scores_proposals", cte("findings") + """, f AS (SELECT doc_id, CASE dimension WHEN 'team_credibility' THEN 'scientific_grounding' ELSE 'evidential_strength' END AS dimension, severity FROM findings WHERE doc_id % 2 = 0 OR dimension = 'team_credibility'),
  s AS (SELECT doc_id, dimension, count(*) AS finding_count, round(least(1, greatest(0.1, 0.6 + sum(CASE severity WHEN 'red_flag' THEN -0.2 WHEN 'concern' THEN -0.1 ELSE 0 END))), 4) AS score FROM f GROUP BY ALL),
  i AS (SELECT DISTINCT doc_id, dimension FROM (SELECT doc_id FROM findings), (VALUES ('scientific_grounding'), ('evidential_strength')) v(dimension))
  SELECT i.doc_id, i.dimension, coalesce(finding_count, 0) AS finding_count, coalesce(score, 0.6) AS score FROM i LEFT JOIN s USING (doc_id, dimension)""")
def _(spark, d):
    f = view(spark, d, "findings")
    mapped = f.filter("doc_id % 2 = 0 OR dimension = 'team_credibility'").withColumn(
        "dimension", F.when(F.col("dimension") == "team_credibility", "scientific_grounding").otherwise("evidential_strength"))
    scores = S.rubric_scores(mapped, rubrics=C.PROPOSAL_RUBRICS, cap=1.0)
    return S.with_baselines(f, scores, C.PROPOSAL_RUBRICS, "doc_id")


_W = lookup_sql(C.ARTICLE_WEIGHTS, "dimension", "0")


@query("composite_articles", cte("findings") + f", {_FIX}, s AS (SELECT doc_id, dimension, round(greatest(0.1e0, 0.7e0 + sum({_PEN})), 4) AS score FROM f GROUP BY ALL) SELECT doc_id, coalesce(round(sum(score * {_W}) / nullif(sum({_W}), 0), 4), round(avg(score), 4), 0) AS composite FROM s GROUP BY doc_id")
def _(spark, d):
    return S.composite(S.rubric_scores(view(spark, d, "findings")), C.ARTICLE_WEIGHTS, ("doc_id",))


@query("composite_dao", cte("lines") + f", s AS (SELECT source_path, category, round(100.0 * count(*) FILTER (verdict IN ('valid','positive')) / nullif(count(*) FILTER (verdict IN ('valid','positive','invalid','negative')), 0), 0) AS score FROM lines GROUP BY ALL), w AS (SELECT *, CASE WHEN score IS NOT NULL THEN {lookup_sql(C.DAO_WEIGHTS, 'category')} END AS w FROM s) SELECT source_path, ceil(round(sum(score*w)/nullif(sum(w),0), 9)) AS composite FROM w GROUP BY source_path")
def _(spark, d):
    good, bad = F.col("verdict").isin("valid", "positive"), F.col("verdict").isin("invalid", "negative")
    s = view(spark, d, "lines").groupBy("source_path", "category").agg(
        F.round(F.lit(100.0) * F.count_if(good) / F.nullif(F.count_if(good | bad), F.lit(0)), 0).alias("score"))
    return S.composite_dao(s, by=("source_path",))


def line_weight_sql():
    kinds = {f"{c}|{k}": w for c, m in C.LINE_TYPE_WEIGHTS.items() for k, w in m.items()}
    return f"round(coalesce({lookup_sql(C.SOURCE_WEIGHTS, 'source_kind')}, 1.0) * coalesce({lookup_sql(kinds, '''category || '|' || line_type''')}, 1.0), 4)"


@query("line_weights", cte("lines") + f" SELECT line_id, CAST({line_weight_sql()} AS DOUBLE) AS weight FROM lines")
def _(spark, d):
    return S.line_weights(view(spark, d, "lines")).select("line_id", "weight")


@query("category_scores", cte("lines") + f""", w AS (SELECT *, CAST({line_weight_sql()} AS DOUBLE) AS ew, line_id % 50 AS cluster_id FROM lines),
 a AS (SELECT category, count(*) AS line_count, count(DISTINCT cluster_id) AS cluster_count, count(DISTINCT source_path) AS source_count,
 count(*) FILTER (verdict IN ('valid','positive')) AS favorable, count(*) FILTER (verdict IN ('invalid','negative')) AS unfavorable,
 coalesce(sum(ew) FILTER (verdict IN ('valid','positive')), 0) AS gw, coalesce(sum(ew) FILTER (verdict IN ('invalid','negative')), 0) AS bw FROM w GROUP BY category)
 SELECT category, line_count, cluster_count, source_count, favorable, unfavorable, round(gw, 4) AS favorable_weight, round(bw, 4) AS unfavorable_weight,
 CAST(round_even(round(100.0 * gw / nullif(gw + bw, 0), 8), 0) AS INT) AS score, CAST(round_even(round(100.0 * favorable / nullif(favorable + unfavorable, 0), 8), 0) AS INT) AS raw_score FROM a""")
def _(spark, d):
    lines = S.line_weights(view(spark, d, "lines")).withColumn("effective_weight", F.col("weight")).withColumn("cluster_id", F.col("line_id") % 50)
    return S.category_scores(lines)


@query("verdict_totals", cte("lines") + f" SELECT category, verdict, count(*) AS lines, round(sum(CAST({line_weight_sql()} AS DOUBLE)), 4) AS weight FROM lines GROUP BY category, verdict")
def _(spark, d):
    return S.verdict_totals(S.line_weights(view(spark, d, "lines")), weight="weight")


@query("publishable", "SELECT doc_id, trim(text) AS rationale, CAST(ceil(round((doc_id % 101) / 100.0, 4) * 100) AS INT) AS score FROM documents WHERE doc_id % 3 <> 0 AND trim(text) <> ''")
def _(spark, d):
    df = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, "  ").otherwise(F.col("text")).alias("rationale"), ((F.col("doc_id") % 101) / 100.0).alias("score"))
    return S.publishable(df)


_ORIG = "SELECT doc_id, count(*) AS works, round(avg(sim), 4) AS mean_similarity, round(1 - avg(sim), 4) AS originality_score FROM (SELECT doc_id, CASE WHEN work_id % 9 = 0 THEN 0.10 ELSE similarity END AS sim FROM works) GROUP BY doc_id"


@query("originality", cte("works") + f", o AS ({_ORIG}) SELECT d.doc_id, coalesce(works, 0) AS works, coalesce(mean_similarity, 0) AS mean_similarity, coalesce(originality_score, 1.0) AS originality_score FROM documents d LEFT JOIN o USING (doc_id)")
def _(spark, d):
    works = view(spark, d, "works").withColumn("similarity", F.when(F.col("work_id") % 9 != 0, F.col("similarity")))
    return S.originality_of(table(spark, d, "documents"), works, "doc_id", 1.0)


_R = ("r AS (SELECT conv_id AS doc_id, CASE turn % 4 WHEN 0 THEN 'team_credibility' WHEN 1 THEN 'scientific_rigor' WHEN 2 THEN 'originality' ELSE 'cross_cutting' END AS dimension, "
      "min(text) AS rationale, max(turn) / 10.0 AS score FROM conversations GROUP BY 1, 2)")


@query("merge_scores", cte("findings", "works") + f""", {_FIX}, {_R}, e AS (SELECT doc_id, dimension, 0.25 AS score, 0 AS rk FROM r WHERE dimension = 'scientific_rigor' AND doc_id % 2 = 0),
  o AS (SELECT doc_id, 'originality' AS dimension, round(1 - avg(similarity), 4) AS score, 1 AS rk FROM works GROUP BY doc_id),
  rb AS (SELECT doc_id, dimension, round(greatest(0.1e0, 0.7e0 + sum({_PEN})), 4) AS score, 2 AS rk FROM f GROUP BY ALL),
  l AS (SELECT doc_id, dimension, score, 3 AS rk FROM r WHERE trim(rationale) <> ''),
  u AS (SELECT * FROM e UNION ALL SELECT * FROM o UNION ALL SELECT * FROM rb UNION ALL SELECT * FROM l),
  b AS (SELECT * FROM u WHERE dimension NOT IN ('cross_cutting', 'governance_accountability') QUALIFY row_number() OVER (PARTITION BY doc_id, dimension ORDER BY rk) = 1)
  SELECT b.doc_id, b.dimension, b.score, b.rk AS source_rank, coalesce(r.rationale, '') AS rationale FROM b LEFT JOIN r USING (doc_id, dimension)""")
def _(spark, d):
    conv = table(spark, d, "conversations")
    names = F.element_at(F.array(*[F.lit(x) for x in ("team_credibility", "scientific_rigor", "originality", "cross_cutting")]), (F.col("turn") % 4 + 1).cast("int"))
    review = conv.groupBy(F.col("conv_id").alias("doc_id"), names.alias("dimension")).agg(F.min("text").alias("rationale"), (F.max("turn") / 10.0).alias("score"))
    evid = review.filter("dimension = 'scientific_rigor' AND doc_id % 2 = 0").select("doc_id", "dimension", F.lit(0.25).alias("score"))
    orig = S.originality(view(spark, d, "works")).select("doc_id", F.lit("originality").alias("dimension"), F.col("originality_score").alias("score"))
    return S.merge_scores([evid, orig, S.rubric_scores(view(spark, d, "findings"))], review)


@query("funding_snapshot", """WITH o AS (SELECT o_orderkey, o_totalprice AS goal, o_custkey * 150e0 AS raised, epoch(o_orderdate) AS s, epoch(o_orderdate) + 86400 * (o_orderkey % 900) AS e, epoch(TIMESTAMP '1996-06-01 00:00:00') AS n FROM orders),
  t AS (SELECT *, greatest((e - s) / 86400.0, 1) AS total, greatest((n - s) / 86400.0, 0) AS elapsed, greatest((e - n) / 86400.0, 0) AS rest FROM o WHERE goal > 0)
  SELECT o_orderkey, round(raised, 2) AS amount_raised, round(raised / goal * 100, 1) AS percent_funded, CAST(round_even(total, 0) AS INT) AS days_total, CAST(round_even(rest, 0) AS INT) AS days_remaining,
  raised / greatest(elapsed, 1) * total >= goal AS on_track FROM t""")
def _(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey", "o_totalprice AS goal", "o_custkey * 150.0D AS raised", "o_orderdate AS start_date",
                                             "timestamp_seconds(unix_seconds(cast(o_orderdate as timestamp)) + 86400 * (o_orderkey % 900)) AS end_date")
    return S.funding_snapshot(o, "1996-06-01 00:00:00").select("o_orderkey", "amount_raised", "percent_funded", "days_total", "days_remaining", "on_track")
