"""Material rows: canonical keys, evidence units, tag reuse, compound scores, coverage and pathway roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions.columns import as_col, case, clamp, contains_any, lit_array, lookup, text_of
from attestra.functions.excerpts import label_sections, snippet
from attestra.functions.rules import PATTERNS, longevity_override, pattern_hits, risk_override, rule_text
from attestra.functions.variant import any_field, field, list_field, text_field
from attestra.operators.joins import maybe_met
from attestra.operators.ranking import distinct_first, first_rows

# ---- fixed values: keys, sources, weights --------------------------------------------------------
KEYLESS_SOURCES = ("compound_name", "discover_metadata", "discover_round_meta", "europe_pmc_query_stats")
ID_FIELDS = (("pmid", "pmid"), ("pmcid", "pmcid"), ("doi", "doi"), ("openalex_id", "openalex"), ("nct_id", "nct"), ("aid", "aid"),
             ("activity_id", "activity"), ("pathway_id", "kegg"))
UNIT_SKIPPED_SOURCES = KEYLESS_SOURCES + ("clinical_trials_meta", "pubchem_bioassays_meta", "openalex_grounding_meta", "openalex_risk_meta", "chembl_molecule")
SINGLE_COVERAGE = {
    "europe_pmc": "europe_pmc", "openalex_work": "openalex_grounding", "openalex_grounding": "openalex_grounding",
    "pubchem_bioassay": "pubchem_bioassays", "pubchem_bioassays_meta": "pubchem_bioassays", "chembl_mechanism": "chembl",
    "chembl_activity": "chembl", "chembl_molecule": "chembl", "clinical_trials": "clinical_trials", "kegg_pathway": "kegg",
    "kegg_summary": "kegg", "openfda_drug_label": "openfda_labels", "openfda_faers": "faers",
}
COMBO_COVERAGE = {
    "europe_pmc": "literature", "openalex_grounding": "literature", "openalex_risk": "literature", "openalex_work": "literature",
    "clinical_trials": "clinical_trials", "kegg_summary": "kegg", "kegg_pathway": "kegg", "chembl_mechanism": "chembl",
    "chembl_activity": "chembl", "pubchem_bioassay": "pubchem", "openfda_faers": "openfda", "openfda_drug_label": "openfda",
}
RISK_WEIGHTS = {"direct_human_safety": 0.75, "interaction_or_combination_risk": 0.7, "toxicity_or_adverse_signal": 0.6, "pharmacology_risk_theoretical": 0.35}
DEFAULT_GROUNDING, DEFAULT_RISK = 50.0, 25.0
PATHWAY_KEYWORDS = {
    "mTOR": "mtor", "autophagy": "autophagy", "AMPK": "ampk", "apoptosis": "apoptosis", "cell cycle": "cell cycle",
    "oxidative stress": "oxidative stress", "NAD": "nad", "sirtuin": "sirtuin", "insulin signaling": "insulin signaling", "senescence": "senescence",
}


def norm_title(title: Column) -> Column:
    return F.substring(F.regexp_replace(F.lower(F.trim(title)), r"(?U)\s+", " "), 1, 120)


def _digest16(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def material_key(source_type="source_type", content="content") -> Column:
    """Canonical key of a material row: an id field, then rules by source; null for rows that never de-duplicate."""
    src = F.trim(text_of(source_type))
    ids = [F.concat(F.lit(f"{prefix}:"), F.lower(F.trim(any_field(content, name)))) for name, prefix in ID_FIELDS]
    label_ids = [F.concat(F.lit("label:"), F.lower(F.trim(any_field(content, k)))) for k in ("set_id", "id", "spl_id")]
    label_title = F.concat(F.lit("label:title:"), norm_title(F.coalesce(text_field(content, "title"), text_field(content, "brand_name"))))
    mech = F.concat_ws("|", *[text_of(field(content, k)) for k in ("target_chembl_id", "mechanism_of_action", "action_type")])
    title = F.coalesce(*[text_field(content, k) for k in ("title", "brief_title", "official_title")])
    text = F.substring(F.coalesce(any_field(content, "assay_description"), any_field(content, "prose")), 1, 200)
    by_title = F.concat(src, F.lit(":title:"), _digest16(norm_title(title)))
    by_text = F.when(F.trim(text) != "", F.concat(src, F.lit(":hash:"), _digest16(text)))
    rest = case(
        (src == "openfda_faers", "faers:aggregate"),
        (src == "chembl_mechanism", F.concat(F.lit("chembl_mech:"), _digest16(mech))))
    label = F.when(src == "openfda_drug_label", F.coalesce(*label_ids, label_title))
    keyless = (src == "") | F.endswith(src, F.lit("_meta")) | src.isin(*KEYLESS_SOURCES)
    return F.when(~keyless, F.coalesce(*ids, rest, label, by_title, by_text))


def dedupe_material(rows: DataFrame, order_by: Sequence, by: Sequence[str] = ()) -> DataFrame:
    keyed = rows.withColumn("material_key", material_key())
    key = F.when(F.col("material_key").isNotNull(), F.struct(*by, "material_key")) if by else F.col("material_key")
    return distinct_first(keyed, key, order_by)


def evidence_units(rows: DataFrame, by: Sequence[str], order_by: Sequence, k: int = 15, keep: Column | None = None, held: Sequence[str] = ()) -> DataFrame:
    """First k rows per item that carry a snippet; meta sources are left out."""
    base = rows.filter(keep) if keep is not None else rows.filter(~F.col("source_type").isin(*UNIT_SKIPPED_SOURCES))
    base = base.withColumn("snippet", snippet(held=held)).filter(F.col("snippet").isNotNull())
    picked = first_rows(base, by, order_by, k, "unit_no")
    unit_id = F.coalesce(material_key(), F.concat_ws(":", "source_type", (F.col("unit_no") - 1).cast("string")))
    return picked.withColumn("unit_id", unit_id)


def reuse_tags(rows: DataFrame, cache: DataFrame, key: str = "material_key", tagger=None) -> DataFrame:
    """Rows with a complete cached tag pair take it; keyless rows see the rules only; the rest go to the tagger, then the rules.

    ``cache`` has one row per key; ``tagger`` maps a DataFrame to one with fresh tags.
    """
    tags = ("longevity_relevance", "risk_relevance")
    cached = cache.filter(F.col(key).isNotNull() & F.col(tags[0]).isNotNull() & F.col(tags[1]).isNotNull()).select(
        key, *[F.col(t).alias(f"_{t}") for t in tags])
    joined = rows.join(cached, key, "left")
    hit = F.col("_longevity_relevance").isNotNull()
    cols = [c for c in rows.columns if c not in tags]
    reused = joined.filter(hit).select(*cols, *[F.col(f"_{t}").alias(t) for t in tags], F.lit("cache").alias("tag_source"))
    fresh = joined.filter(~hit).select(*rows.columns)
    todo = fresh.filter(F.col(key).isNotNull()) if tagger else None
    ruled = apply_rules(fresh.filter(F.col(key).isNull()) if tagger else fresh).withColumn("tag_source", F.lit("rules"))
    out = reused.unionByName(ruled.select(reused.columns))
    if tagger:
        out = out.unionByName(apply_rules(tagger(todo)).withColumn("tag_source", F.lit("tagger")).select(reused.columns))
    return out


def apply_rules(rows: DataFrame, ascii_words: bool = False, hits: str | None = None) -> DataFrame:
    """Both overrides over the rule text, which is built and searched once per row. ``ascii_words`` as in ``rules.matches``; ``hits`` names a column that keeps what was found."""
    flags = F.exists(F.map_values(field("content", "longevity_pathway_flags", "map<string,boolean>")), lambda v: v)
    # explode of one value: the patterns run once for a row, where a plain column would be put in wherever one of its fields is used
    found = F.explode(F.array(pattern_hits(F.col("_text"), ascii_words=ascii_words))).alias("_hits")
    text = rows.withColumn("_text", rule_text(content_json=F.to_json("content"))).select(*rows.columns, found)
    hit = {k: F.col(f"_hits.{k}") for k in PATTERNS}
    longevity = longevity_override(hit, "source_type", "longevity_relevance", flags)
    tagged = text.withColumns({"_l": longevity, "_r": risk_override(hit, "source_type", "risk_relevance")}).withColumns(
        {"longevity_relevance": F.col("_l"), "risk_relevance": F.col("_r")}).drop("_l", "_r")
    return tagged.drop("_hits") if hits is None else tagged.withColumnRenamed("_hits", hits)


def compound_scores(units: DataFrame, by: Sequence[str]) -> DataFrame:
    """Grounding and risk fractions, null where no tag counts."""
    tag = F.col("longevity_relevance")
    direct, indirect = F.count_if(tag == "direct_longevity"), F.count_if(tag == "indirect_longevity_mechanism")
    risk = F.round(F.avg(lookup(RISK_WEIGHTS, F.col("risk_relevance"))), 2)
    return units.groupBy(*by).agg(
        F.round((direct + indirect * 0.65) / F.nullif(direct + indirect, F.lit(0)), 2).alias("grounding"), risk.alias("risk"))


def to_percent(value) -> Column:
    """Fractions up to one become percents; larger values already are."""
    v = as_col(value).cast("double")
    return F.round(F.when(v <= 1.0, v * 100.0).otherwise(v), 2)


def compound_composite(grounding: Column, risk: Column) -> Column:
    """Mean of grounding and inverted risk, rounded up; one side alone when the other is missing."""
    safe = F.lit(100.0) - risk
    both = (grounding + safe) / 2.0
    return F.ceil(F.round(F.coalesce(both, grounding, safe), 6)).cast("int")


def combo_scores(compounds: DataFrame, shared_pathways: DataFrame, mentions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean grounding and risk, compatibility from overlaps, and their mean (risk is not inverted here)."""
    keys = list(by)
    base = compounds.groupBy(*keys).agg(F.round(F.avg("grounding"), 4).alias("_g"), F.round(F.avg("risk"), 4).alias("_r"))
    n = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    joined = base.join(n(shared_pathways, "_sp"), keys, "left").join(n(mentions, "_em"), keys, "left")
    drop = F.coalesce("_sp", F.lit(0)) * 14.0 + F.coalesce("_em", F.lit(0)) * 12.0
    g, r = to_percent("_g"), F.coalesce(to_percent("_r"), F.lit(DEFAULT_RISK))
    c = F.round(clamp(F.lit(100.0) - drop, 42.0, 100.0), 2)
    mean = F.round(F.when(g.isNotNull(), (g + r + c) / 3.0).otherwise((r + c) / 2.0), 2)
    return joined.select(*keys, g.alias("grounding_pct"), r.alias("risk_pct"), c.alias("compatibility_pct"), F.ceil(mean).cast("int").alias("composite"))


def coverage(rows: DataFrame, by: Sequence[str], source_map: Mapping[str, str]) -> DataFrame:
    """Every expected source with a present flag per item."""
    expected = sorted(set(source_map.values()))
    seen = rows.groupBy(*by).agg(F.collect_set(lookup(source_map, F.col("source_type"))).alias("_seen"))
    return seen.select(*by, F.explode(lit_array(expected)).alias("source"), "_seen").select(
        *by, "source", F.array_contains("_seen", F.col("source")).alias("present"))


def coverage_union(covered: DataFrame, by: Sequence[str]) -> DataFrame:
    return covered.groupBy(*by, "source").agg(F.bool_or("present").alias("present"))


def label_matches(labels: DataFrame, aliases: DataFrame, key: str, names: Sequence[str] = ("generic_name", "substance_name", "brand_name"), gram: int = 3) -> DataFrame:
    """Labels of a key with an alias inside any of their names, any case.

    Name and alias meet on (key, first letters of the alias), then the containment is checked.
    """
    all_names = F.flatten(F.array(*[F.coalesce(list_field("content", f"openfda.{n}"), F.array().cast("array<string>")) for n in names]))
    return labels.join(_contained(labels.select(key, "label_id", F.explode(all_names).alias("_name")), aliases, key, "_name", "alias", gram)
                       .select(key, "label_id").distinct(), [key, "label_id"], "left_semi")


def _contained(texts: DataFrame, needles: DataFrame, key: str, text: str, needle: str, gram: int) -> DataFrame:
    """Pairs of the same key whose needle lies in the text, met on the needle's first letters.

    Exploded rows are two hashes each, and those that meet no needle go before they move; key and containment are checked on the texts themselves.
    """
    low = F.lower(F.trim(F.col(needle)))
    n = needles.select(key, low.alias("_needle")).filter("_needle <> ''").distinct()
    short = n.filter(F.length("_needle") < gram)
    met_at = lambda g: F.xxhash64(F.col(key), g)
    # needles of the first letters' length or longer meet on as many letters as they have, up to twice that
    long = n.filter(F.length("_needle") >= gram).withColumn("_n", F.least(F.length("_needle"), F.lit(2 * gram)))
    seeking = long.select(met_at(F.substring("_needle", F.lit(1), F.col("_n"))).alias("_at"), F.col(key).alias("_key"), "_needle")
    t = texts.withColumn("_low", F.lower(F.col(text)))
    t = t.withColumn("_tid", F.xxhash64(key, "_low"))
    grams = F.flatten(F.array(*[F.regexp_extract_all("_low", F.lit(rf"(?s)(?=(.{{{k}}}))"), 1) for k in range(gram, 2 * gram + 1)]))
    met_rows = t.select("_tid", F.explode(F.array_distinct(F.transform(grams, met_at))).alias("_at"))
    candidates = maybe_met(met_rows, seeking, "_at").hint("merge").join(seeking, "_at").select("_tid", "_key", "_needle").distinct()
    met = t.hint("merge").join(candidates, "_tid").filter((F.col(key) == F.col("_key")) & F.contains("_low", F.col("_needle"))).drop("_key")
    few = t.join(short, [key]).filter(F.contains("_low", F.col("_needle")))
    return met.unionByName(few.select(met.columns))


def assays_by_aid(rows: DataFrame, by: Sequence[str], pos: str) -> DataFrame:
    """Count, first assay type and first non-empty title per assay id."""
    title = F.nullif(F.col("title"), F.lit(""))
    return rows.groupBy(*by, "aid").agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.min_by(title, F.when(title.isNotNull(), F.col(pos))), F.lit("")).alias("title"),
        F.min_by("assay_type", pos).alias("assay_type"))


# ---- fixed value: words that lift an assay ------------------------------------------------------
ASSAY_KEYWORDS = (r"longevity|aging|lifespan|healthspan|senescence|cytotox|toxic|viability|autophagy|mtor|ampk|apoptosis|prolif|cell.?line|survival|osteoclast")


def rank_assays(assays: DataFrame, by: Sequence[str], k: int = 8, pattern: str = ASSAY_KEYWORDS, order="aid") -> DataFrame:
    """Assays with most keyword hits in the title, then most rows."""
    hits = F.regexp_count("title", F.lit("(?iU)" + pattern))
    ranked = assays.withColumn("hits", hits)
    return first_rows(ranked, by, [F.desc("hits"), F.desc("row_count"), as_col(order)], k, "rank")


def merge_articles(hits: DataFrame, by: Sequence[str] = (), seq: str = "seq") -> DataFrame:
    """One article per key: the longest abstract, then most citations, then the earliest; query names united."""
    key = F.coalesce(*[F.concat(F.lit(f"{k}:"), F.nullif(F.col(k).cast("string"), F.lit(""))) for k in ("pmid", "pmcid", "doi", "id") if k in hits.columns])
    cites = F.coalesce(F.floor(F.col("cited_by").try_cast("double")), F.lit(0))
    order = F.struct(F.length(F.coalesce("abstract", F.lit(""))).alias("a"), cites.alias("c"), (-F.col(seq)).alias("s"))
    rest = [c for c in hits.columns if c not in (*by, "query_name")]
    keyed = hits.withColumn("article_key", key).filter(F.col("article_key").isNotNull())
    merged = keyed.groupBy(*by, "article_key").agg(F.max_by(F.struct(*rest), order).alias("_best"), F.array_sort(F.collect_set("query_name")).alias("source_queries"))
    return merged.select(*by, "article_key", "source_queries", *[F.col(f"_best.{c}").alias(c) for c in rest])


def adverse_events(reports: DataFrame, by: Sequence[str], query: str = "query_name", patients: str = "patient") -> DataFrame:
    """Distinct reaction terms over nested reports and the largest report count of a query."""
    sizes = reports.groupBy(*by, query).agg(F.count("*").alias("_n")).groupBy(*by).agg(F.max("_n").alias("report_count"))
    reactions = reports.select(*by, F.explode(patients).alias("_p")).select(*by, F.explode("_p.reaction").alias("_r"))
    pt, version = F.col("_r.reactionmeddrapt"), F.col("_r.reactionmeddraversionpt")
    term = F.trim(F.coalesce(F.nullif(pt, F.lit("")), version))
    terms = reactions.select(*by, term.alias("term")).filter("term <> ''").groupBy(*by).agg(F.array_sort(F.collect_set("term")).alias("reaction_terms"))
    return sizes.join(terms, list(by), "left").withColumn("reaction_terms", F.coalesce("reaction_terms", F.array().cast("array<string>")))


def pathway_flags(pathways: DataFrame, by: Sequence[str], keywords: Mapping[str, str] = PATHWAY_KEYWORDS) -> DataFrame:
    """Ten flags per item: any name or description holds the keyword."""
    blob = F.lower(F.concat_ws(" ", text_of("name"), text_of("description_snippet")))
    flags = pathways.groupBy(*by).agg(*[F.bool_or(F.contains(blob, F.lit(w))).alias(f"_{i}") for i, w in enumerate(keywords.values())])
    entries = F.map_from_arrays(lit_array(keywords), F.array(*[F.col(f"_{i}") for i in range(len(keywords))]))
    return flags.select(*by, F.explode(entries).alias("flag", "present"))


def kegg_rollup(rows: DataFrame, by: Sequence[str], seq: str, names: int = 10) -> DataFrame:
    """Flags true in any pathway summary, ordered distinct names (first ones) and drug ids."""
    summary = rows.filter(F.col("source_type") == "kegg_summary")
    flags = F.map_keys(F.map_filter(field("content", "longevity_pathway_flags", "map<string,boolean>"), lambda _, v: v))
    keys = list(by)

    def ordered(path, limit, name):
        items = summary.select(*keys, seq, F.posexplode(list_field("content", path)).alias("_i", "_v")).filter("_v <> ''")
        first = items.groupBy(*keys, "_v").agg(F.min(F.struct(seq, "_i")).alias("_at"))
        kept = first_rows(first, keys, [F.col("_at")], limit) if limit else first
        return kept.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_v"))), lambda s: s["_v"]).alias(name))

    present = summary.select(*keys, F.explode(flags).alias("_f")).groupBy(*keys).agg(F.array_sort(F.collect_set("_f")).alias("flags_present"))
    out = summary.select(*keys).distinct().join(present, keys, "left").join(ordered("pathway_names", names, "pathway_names"), keys, "left").join(
        ordered("kegg_drug_ids", 0, "kegg_drug_ids"), keys, "left")
    empty = F.array().cast("array<string>")
    return out.select(*keys, *[F.coalesce(c, empty).alias(c) for c in ("flags_present", "pathway_names", "kegg_drug_ids")]).withColumn(
        "kegg_available", F.size("kegg_drug_ids") > 0)


def shared_pathways(flags: DataFrame, by: Sequence[str], item: str, at_least: int = 2) -> DataFrame:
    """Flags true for two or more items, with the items."""
    return (flags.filter("present").groupBy(*by, "flag").agg(F.array_sort(F.collect_set(item)).alias("items"))
            .filter(F.size("items") >= at_least))


def tag_counts(rows: DataFrame, by: Sequence[str], tag: str) -> DataFrame:
    return rows.filter(as_col(tag).isNotNull()).groupBy(*by, tag).agg(F.count("*").alias("rows"))


def name_tokens(name: Column | str) -> Column:
    """Lower-cased parts of a name with at least four characters."""
    return F.array_distinct(F.filter(F.split(F.lower(as_col(name)), r"(?U)[\s\-/,]+"), lambda t: F.length(t) >= 4))


def name_mentions(items: DataFrame, blocks: DataFrame, bundle: str, item: str, seq: str, text: str = "text") -> DataFrame:
    """Per ordered pair of items, the first block of the source that holds a name token of the target, with a snippet.

    Tokens and blocks meet on (bundle, first four letters), not on every pair of items.
    """
    gram = F.substring("_token", 1, 4)
    tokens = items.select(bundle, F.col(item).alias("_target"), F.explode(name_tokens(item)).alias("_token")).withColumn("_at", F.xxhash64(F.col(bundle), gram))
    low = F.lower(F.col(text))
    grams = F.transform(F.array_distinct(F.regexp_extract_all(low, F.lit(r"(?s)(?=(.{4}))"), 1)), lambda g: F.xxhash64(F.col(bundle), g))
    # letters that start no token of the bundle go before they move
    seen = maybe_met(blocks.select(bundle, item, seq, F.explode(grams).alias("_at")), tokens, "_at")
    near = seen.hint("merge").join(tokens, [bundle, "_at"]).filter(F.col(item) != F.col("_target")).select(bundle, item, seq, "_target", "_token").distinct()
    hit = blocks.select(bundle, item, seq, low.alias("_low")).hint("merge").join(near, [bundle, item, seq]).filter(F.contains("_low", F.col("_token")))
    first = hit.groupBy(bundle, F.col("_target").alias("mentioned"), F.col(item).alias("found_in")).agg(
        F.min(F.struct(F.col(seq), F.col("_token"))).alias("_first"))
    at = first.select(bundle, "mentioned", "found_in", F.col(f"_first.{seq}").alias(seq), F.col("_first._token").alias("token"))
    block = F.xxhash64(bundle, "found_in", seq)
    named = blocks.select(bundle, F.col(item).alias("found_in"), seq, F.col(text).alias("_text")).withColumn("_block", block)
    back = at.join(maybe_met(named, at.withColumn("_block", block), "_block").drop("_block"), [bundle, "found_in", seq])
    pos = F.instr(F.lower("_text"), F.col("token")) - 1
    start, end = F.greatest(pos - 60, F.lit(0)), F.least(F.length("_text"), pos + 120)
    cut = F.concat(F.when(start > 0, "…").otherwise(""), F.substring("_text", (start + 1).cast("int"), (end - start).cast("int")),
                   F.when(end < F.length("_text"), "…").otherwise(""))
    return back.select(bundle, "mentioned", "found_in", seq, "token", cut.alias("snippet"))


def spl_match(rows: DataFrame, by: Sequence[str], name: str, seq: str) -> DataFrame:
    """Label rows whose text holds a token of the item's name: counts, distinct interaction texts and mechanism text."""
    labels = rows.filter(F.col("source_type") == "openfda_drug_label")
    text = F.lower(F.to_json("content"))
    hit = F.exists(name_tokens(name), lambda t: F.contains(text, t))
    marked = labels.withColumn("_hit", hit)
    counts = marked.groupBy(*by).agg(F.count("*").alias("labels_total"), F.count_if("_hit").alias("labels_matched"))
    matched = marked.filter("_hit")
    inter = matched.select(*by, F.explode(F.array_distinct(label_sections("content", ("drug_interactions",), 2000))).alias("_t")).distinct()
    return counts.join(inter.groupBy(*by).agg(F.count("*").alias("interaction_excerpts")), list(by), "left").withColumn(
        "interaction_excerpts", F.coalesce("interaction_excerpts", F.lit(0)))


def bundle_reviews(bundle: DataFrame, reviews: DataFrame, rows: DataFrame, item: str) -> DataFrame:
    """Scores and rationales of single reviews on the combination's items, with a warning per missing part."""
    tag = lambda c: F.count_if(F.col(c).isNotNull())
    counts = rows.groupBy(item).agg(tag("longevity_relevance").alias("longevity_rows"), tag("risk_relevance").alias("risk_rows"))
    joined = bundle.join(counts, item, "left").join(reviews, item, "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    warn = F.array_compact(F.array(
        F.when(n("longevity_rows") == 0, "no longevity rows"), F.when(n("risk_rows") == 0, "no risk rows"), F.when(F.col("review_score").isNull(), "no review")))
    return joined.withColumns({"longevity_rows": n("longevity_rows"), "risk_rows": n("risk_rows"), "warnings": warn})


def stitch_rationales(items: DataFrame, by: Sequence[str], name: str, score: str, rationale: str) -> DataFrame:
    """Named blocks of text in name order: "name (score s): text"."""
    text = F.trim(text_of(rationale))
    block = F.concat(F.col(name), F.coalesce(F.concat(F.lit(" (score "), F.col(score).cast("string"), F.lit(")")), F.lit("")), F.lit(": "), text)
    kept = items.filter(text != "").select(*by, F.struct(F.col(name).alias("n"), block.alias("b")).alias("_s"))
    return kept.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_s")), lambda s: s["b"]), "\n\n").alias("stitched"))


def rank_synonyms(names: DataFrame, by: Sequence[str], name: str, primary: str, order, k: int = 8) -> DataFrame:
    """Distinct names ignoring case, those holding the first word of the primary name first, registry numbers last, short before long."""
    trimmed = names.withColumn("synonym", F.trim(F.col(name))).filter("synonym <> ''")
    unique = first_rows(trimmed, [*by, F.lower("synonym")], [as_col(order)])
    token = F.lower(F.element_at(F.split(F.trim(F.col(primary)), r"\s+"), 1))
    lacks = F.when((token != "") & F.contains(F.lower("synonym"), token), 0).otherwise(1)
    registry = F.when(F.col("synonym").rlike(r"^\d{2,7}-\d{2}-\d$"), 1).otherwise(0)
    return first_rows(unique, by, [lacks, registry, F.length("synonym"), as_col(order)], k, "rank")


def distinct_excerpts(labels: DataFrame, by: Sequence[str], order: str, texts: str, size: int = 2000) -> DataFrame:
    """by, excerpt, first, pos: the distinct openings (``size`` characters) of the label texts (an array column), each with the label and place of its first.

    The opening is the excerpt itself, so texts that differ only beyond it are one. Minima go before the shuffle, so an excerpt that a third of
    all labels repeat costs one row a task. Null, empty and blank texts are left out; null groups are a group; no rows give no rows.
    """
    parts = labels.select(*by, F.col(order).alias("first"), F.posexplode(texts).alias("pos", "_t")).filter(F.trim("_t") != "")
    least = parts.groupBy(*by, F.substring("_t", 1, size).alias("excerpt")).agg(F.min(F.struct("first", "pos")).alias("x"))
    return least.select(*by, "excerpt", "x.first", "x.pos")
