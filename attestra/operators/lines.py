"""Project lines, findings, files, links and bundles: filters, normal forms and roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra import config as C
from attestra.functions.columns import as_col, case, contains_any, lookup, text_of
from attestra.functions.text import known_citations, severity_rank, source_key
from attestra.functions.urls import follow_block_reason, is_blocked_anchor, url_key
from attestra.operators.ranking import first_rows

# ---- fixed values: file routes, verdicts, scope words ----------------------------------------------
FILE_ROUTES = {"pdf": "pdf", "png": "image", "jpg": "image", "jpeg": "image", "gif": "image", "webp": "image", "svg": "image", "mp4": "video", "mov": "video",
               "avi": "video", "webm": "video", "mkv": "video", "txt": "text", "md": "text", "html": "text", "htm": "text", "docx": "text", "json": "text", "csv": "text", "rtf": "text"}
MIME_ROUTES = {"application/pdf": "pdf", "application/x-pdf": "pdf", "image/png": "image", "image/jpeg": "image", "image/gif": "image", "image/webp": "image",
               "image/svg+xml": "image", "video/mp4": "video", "video/quicktime": "video", "video/webm": "video", "video/x-msvideo": "video", "text/plain": "text",
               "text/markdown": "text", "text/html": "text", "application/json": "text",
               "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "text"}
SKIPPED_FILES = ("profile.json", "manifest.json", "dataroom.json", "profiles-index.json", "links.json", "crawl-manifest.json", "crawl-extracted-links.json", "nitter-manifest.json")
SKIPPED_NAMES = r"(?i)brand.?guide|guidelines|logo|icon|dummy|jwt.?test|jwt.?script"
EXTRACTABLE_TYPES = ("application/pdf", "image/png", "image/jpeg", "image/gif", "image/webp")
SCOPE_WORDS = ("budget", "cost", "fund", "scope", "timeline", "personnel", "equipment", "method")
LINE_TYPES = ("claim", "feature", "mission", "fact")
SCIENTIFIC_VERDICTS, STANCE_VERDICTS = ("valid", "invalid", "inconclusive"), ("positive", "negative", "neutral")


def active_campaigns(df: DataFrame, now: str, status="status", end="end_date") -> DataFrame:
    """Campaigns that are open (or say nothing) and end after ``now``."""
    return df.filter((as_col(status).isNull() | (as_col(status) == "OPEN")) & F.coalesce(as_col(end).cast("string").try_cast("timestamp") > F.lit(now).cast("timestamp"), F.lit(False)))


def profile_skip_reason(found: Column, failed: Column, name="name", description="description", topic="topic", organization="organization", token_uri="token_uri",
                        external_url="external_url", image="image") -> Column:
    t = {k: F.trim(text_of(v)) for k, v in dict(n=name, d=description, t=topic, o=organization, u=token_uri, e=external_url, i=image).items()}
    size = F.length(t["d"])
    rich = (size >= 40) | ((size >= 12) & ((t["t"] != "") | (t["o"] != ""))) | (t["u"] != "") | (t["e"] != "") | ((t["i"] != "") & (size >= 20))
    return case((failed, "fetch_error"), (~found, "not_in_data_api"), ((t["n"] == "") | ~rich, "thin_metadata"))


def follow_candidates(extracted: DataFrame, seeds: DataFrame, planned: DataFrame, url: str = "url", text: str = "text", seed: str = "seed_url") -> DataFrame:
    """Every candidate link with the reason it is not followed, null when it may be."""
    key = lambda df, flag: df.select(url_key(url).alias("_key"), F.lit(True).alias(flag)).distinct()
    joined = extracted.withColumn("_key", url_key(url)).join(key(seeds, "_seed"), "_key", "left").join(key(planned, "_planned"), "_key", "left")
    reason = case((is_blocked_anchor(text), "blocked_anchor"), (F.col("_seed"), "already_in_links_json"), (F.col("_planned"), "already_planned"),
                  default=follow_block_reason(F.col(url), F.col(seed)))
    return joined.withColumn("reason", reason).drop("_key", "_seed", "_planned")


def file_route(name, content_type=None) -> Column:
    """Route by name rules, then extension, then MIME type; "skip" otherwise."""
    n = as_col(name)
    ext = F.lower(F.regexp_extract(n, r"[^/.]\.([^./]+)$", 1))
    mime = F.lower(F.trim(F.substring_index(text_of(content_type) if content_type is not None else F.lit(""), ";", 1)))
    return case((n.isin(*SKIPPED_FILES) | n.rlike(SKIPPED_NAMES), "skip"), default=F.coalesce(lookup(FILE_ROUTES, ext), lookup(MIME_ROUTES, mime), F.lit("skip")))


def inventory(manifest: DataFrame, dataroom: DataFrame, by: Sequence[str], order: Sequence) -> DataFrame:
    """Manifest entries with their data-room type and route; the first of a file name counts, skipped routes drop out."""
    name = F.coalesce(F.nullif(F.col("file_name"), F.lit("")), F.nullif(F.element_at(F.split("path", "/"), -1), F.lit("")))
    named = manifest.withColumn("file_name", name).filter("file_name IS NOT NULL")
    first = first_rows(named, [*by, "file_name"], order)
    types = dataroom.groupBy(*by, "path").agg(F.max("content_type").alias("content_type"))
    return first.join(types, [*by, "path"], "left").withColumn("route", file_route("file_name", "content_type")).filter("route <> 'skip'")


def public_files(files: DataFrame, access="access_level", content_type="content_type") -> DataFrame:
    return files.filter((as_col(access) == "PUBLIC") & as_col(content_type).isin(*EXTRACTABLE_TYPES))


def dataroom_hash(files: DataFrame, by: Sequence[str], version: str = "1") -> DataFrame:
    """Fingerprint of a project's public files."""
    h = F.sha2(F.concat_ws(":", "did", "path", F.col("version").cast("string")), 256)
    return files.filter("access_level = 'PUBLIC'").groupBy(*by).agg(
        F.concat(F.lit(f"{version}:"), F.sha2(F.array_join(F.array_sort(F.collect_list(h)), ""), 256)).alias("fingerprint"))


def publishable_bundles(files: DataFrame, item: str, name: str = "file_name") -> DataFrame:
    """Items with an audit, an overview and a review file."""
    n = F.col(name)
    agg = files.groupBy(item).agg(F.bool_or(n == "evidence_audit.md").alias("_a"), F.bool_or(n == "overview.json").alias("_o"),
                                  F.bool_or((n == "review.json") | F.endswith(n, F.lit("-review.json"))).alias("_r"))
    return agg.filter("_a AND _o AND _r").select(item)


def audit_filter(claims: DataFrame, include_self_reported: bool = False, drop_supported: bool = False, grade="evidence_grade") -> DataFrame:
    if include_self_reported:
        return claims
    g = F.coalesce(F.nullif(F.trim(text_of(grade)), F.lit("")), F.lit("unknown"))
    out = ~g.isin("self_reported", "self_reported_method")
    return claims.filter(out & ~g.isin("strong", "moderate") if drop_supported else out)


def clean_findings(findings: DataFrame, dimensions: Sequence[str], excluded: Sequence[str] = C.ARTICLE_EXCLUDED_DIMENSIONS) -> DataFrame:
    """Known, not excluded dimensions only; an unknown severity counts as info."""
    kept = [x for x in dimensions if x not in excluded]
    sev = F.when(F.col("severity").isin(*C.SEVERITIES), F.col("severity")).otherwise("info")
    return findings.filter(F.col("dimension").isin(*kept)).withColumn("severity", sev)


def fallback_category(kind="source_kind", section="section", line_type="line_type") -> Column:
    s, t = F.lower(text_of(section)), as_col(line_type)
    onchain = case((contains_any(s, ("tokenomics", "agreements", "funding")), "governance_tokenomics"), (contains_any(s, ("research_lead", "identity")), "team_credibility"),
                   (F.contains(s, F.lit("description")), "mission_clarity"), default="governance_tokenomics")
    return case((as_col(kind) == "onchain_fact", onchain), (t == "mission", "mission_clarity"), (t == "claim", "scientific_grounding"),
                (t == "feature", "research_output_quality"), default="execution_competence")


def clean_lines(lines: DataFrame, by: Sequence[str], order: Sequence, k: int = 6) -> DataFrame:
    """First k raw lines per chunk, blank ones dropped, unknown types as features, texts and quotes cut."""
    kind = F.lower(F.trim(text_of("line_type")))
    return (first_rows(lines, by, order, k).withColumns({
        "line_type": F.when(kind.isin(*LINE_TYPES), kind).otherwise("feature"), "text": F.substring(F.trim(text_of("text")), 1, 500),
        "verbatim_quote": F.substring(text_of("verbatim_quote"), 1, 400)}).filter("text <> ''"))


def clean_verdicts(lines: DataFrame, scientific="needs_scientific_support", verdict="verdict", cited="citations", retrieved="retrieved") -> DataFrame:
    """Known verdicts only; citations limited to what was retrieved; "valid" without any is inconclusive."""
    v, known = F.lower(F.trim(text_of(verdict))), known_citations(F.transform(as_col(cited), lambda c: F.trim(c)), retrieved)
    sci = F.when(~v.isin(*SCIENTIFIC_VERDICTS), "inconclusive").when((v == "valid") & (F.size(known) == 0), "inconclusive").otherwise(v)
    stance = F.when(v.isin(*STANCE_VERDICTS), v).otherwise("neutral")
    return lines.withColumns({verdict: F.when(as_col(scientific), sci).otherwise(stance), cited: F.when(as_col(scientific), known).otherwise(F.array().cast("array<string>"))})


def scope_findings(findings: DataFrame, by: Sequence[str], order: Sequence, k: int = 8) -> DataFrame:
    text = F.lower(F.concat(text_of("observation"), text_of("section") if "section" in findings.columns else F.lit("")))
    return first_rows(findings.filter(contains_any(text, SCOPE_WORDS)), by, order, k)


def reviewable_items(items: DataFrame) -> DataFrame:
    """items(route, pdf_url, has_profile, ticker, names) with the reason an item cannot be reviewed."""
    r = F.col("route")
    reason = case(((r == "article") & (F.trim(text_of("pdf_url")) == ""), "no_pdf_url"), ((r == "dao") & ~F.coalesce("has_profile", F.lit(False)), "no_profile"),
                  ((r == "compounds") & ((F.trim(text_of("ticker")) == "") | (F.coalesce(F.size("names"), F.lit(0)) == 0)), "no_ticker_or_names"))
    return items.withColumn("reject_reason", reason)


def patch_categories(review: DataFrame, results: DataFrame, by: Sequence[str], cap: int = 6, excluded: Sequence[str] = C.ARTICLE_EXCLUDED_DIMENSIONS) -> DataFrame:
    """Review categories with new rationales: existing ones are extended, new ones fill the free places, worst severity first.

    results(by, dimension, rationale, finding_count, worst, seq); dimensions are few per item by nature.
    """
    keys = list(by)
    own = review.filter(~F.col("dimension").isin(*excluded))
    new = results.select(*keys, "dimension", F.col("rationale").alias("_new"), "finding_count", "worst", "seq")
    both = own.join(new, [*keys, "dimension"], "left")
    note = F.concat(F.col("rationale"), F.lit("\n\n[Document screener — "), F.col("finding_count").cast("string"), F.lit(" additional observation(s)]: "), F.col("_new"))
    extended = both.select(*keys, "dimension", F.coalesce("score", F.when(F.col("_new").isNotNull(), F.lit(0.5))).alias("score"),
                           F.when(F.col("_new").isNull(), F.col("rationale")).when(text_of("rationale") == "", F.col("_new")).otherwise(note).alias("rationale"))
    used = own.groupBy(*keys).agg(F.count("*").alias("_used"))
    fresh = first_rows(new.join(own.select(*keys, "dimension"), [*keys, "dimension"], "left_anti"), keys, [severity_rank("worst"), "seq"], cap, "_rank")
    placed = fresh.join(used, keys, "left").filter(F.col("_rank") <= cap - F.coalesce("_used", F.lit(0)))
    return extended.unionByName(placed.select(*keys, "dimension", F.lit(None).cast("double").alias("score"), F.col("_new").alias("rationale")))


def citation_usage(lines: DataFrame, line_id: str = "line_id", works: str = "retrieved_works", cited: str = "citations") -> DataFrame:
    """Per cited work: line count, first and last line, title of its first use (long form holds the lines themselves)."""
    used = lines.select(line_id, F.explode(F.array_distinct(cited)).alias("work_id"))
    titles = lines.select(line_id, F.explode(works).alias("_w")).select(F.col("_w.work_id").alias("work_id"), F.col(line_id), F.col("_w.title").alias("_t"))
    first = titles.groupBy("work_id").agg(F.min_by("_t", line_id).alias("title"))
    return used.groupBy("work_id").agg(F.count("*").alias("lines"), F.min(line_id).alias("first_line")).join(first, "work_id", "left")


def source_rollup(chunks: DataFrame, lines: DataFrame) -> DataFrame:
    """Chunks, lines and verdict counts per source, with the display rank of its kind."""
    c = chunks.groupBy(source_key().alias("key")).agg(F.count("*").alias("chunks"))
    n = lines.groupBy(source_key().alias("key")).agg(F.count("*").alias("lines"), F.count_if(F.col("verdict").isin(*C.FAVORABLE_VERDICTS)).alias("favorable"),
                                                     F.count_if(F.col("verdict").isin(*C.UNFAVORABLE_VERDICTS)).alias("unfavorable"))
    zero = lambda x: F.coalesce(F.col(x), F.lit(0)).alias(x)
    k = F.col("key")
    starts = lambda p: F.startswith(k, F.lit(p))
    rank = case((starts("crawl::"), F.lit(0)), (k == "onchain", F.lit(1)), (starts("pdf::"), F.lit(2)), (starts("video::"), F.lit(3)), (starts("image::"), F.lit(4)), default=F.lit(5))
    return c.join(n, "key", "full_outer").select("key", *[zero(x) for x in ("chunks", "lines", "favorable", "unfavorable")], rank.alias("rank"))


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def artifact_tags(route: str, doctype, ctx: Mapping[str, Column]) -> Column:
    """Tag list of a published artifact by route; empty values are left out where the route leaves them out."""
    tag = lambda n, v: F.struct(F.lit(n).alias("name"), (v if isinstance(v, Column) else F.lit(v)).alias("value"))
    opt = lambda n, c: F.when(text_of(ctx[c]) != "", tag(n, ctx[c]))
    d = tag("doctype", as_col(doctype))
    tags = {
        "article": [d, tag("platform", "ResearchHub"), tag("category", "Article"), opt("research_name", "name"), opt("review_date", "review_date")],
        "proposal": [tag("platform", "ResearchHub"), tag("category", "Proposal"), d, opt("name", "name"), opt("date", "review_date")],
        "dao": [d, tag("DaoName", text_of(ctx["name"])), tag("platform", "Molecule"), tag("category", "ResearchDAO"), opt("date", "review_date")],
        "compounds": [d, tag("platform", "PumpScience"), tag("category", "compounds"), opt("compounds", "name"), opt("date", "review_date")],
    }[route]
    return F.array_compact(F.array(*tags))


def with_field_after(document, name: str, value, anchors: Sequence[str] = ("review_date", "compound_token", "research_name")) -> Column:
    """JSON object text with a field put right after the first anchor it has, else after its first field."""
    doc = as_col(document)
    fields = F.json_object_keys(doc)
    keys = F.filter(fields, lambda k: k != name)
    anchor = F.coalesce(*[F.when(F.array_contains(keys, a), F.lit(a)) for a in anchors], F.try_element_at(keys, F.lit(1)))
    at = F.coalesce(F.array_position(keys, anchor), F.lit(0)).cast("int")
    order = F.concat(F.slice(keys, F.lit(1), at), F.array(F.lit(name)), F.slice(keys, at + 1, F.size(keys)))
    members = F.from_json(doc, "map<string,variant>")  # a variant keeps whether a member was a string, a number or a list
    quoted = lambda s: F.regexp_replace(F.to_json(F.array(s)), r"^\[|\]$", "")
    body = F.transform(order, lambda k: F.concat(quoted(k), F.lit(":"), F.when(k == name, quoted(as_col(value))).otherwise(F.coalesce(F.to_json(F.try_element_at(members, k)), F.lit("null")))))
    return F.concat(F.lit("{"), F.array_join(body, ","), F.lit("}"))
