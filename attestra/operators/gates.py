"""Claim gates, bucket rules and evidence grades, all as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra import config as C
from attestra.functions.columns import (
    as_col, blank_to_null, case, clamp, contains_any, lit_array, lookup, overlaps, text_of,
)


def merged_tags(*parts: Column | str) -> Column:
    """Distinct trimmed tags of the classification arrays, first-seen order."""
    arrays = [F.coalesce(as_col(p), F.array().cast("array<string>")) for p in parts]
    return F.array_distinct(F.transform(F.flatten(F.array(*arrays)), lambda t: F.trim(t)))


def number(relevancy: Column | str) -> Column:
    return as_col(relevancy).try_cast("double")


def below(relevancy: Column | str, threshold: float) -> Column:
    """A score that is not a number is not low."""
    return F.coalesce(number(relevancy) < threshold, F.lit(False))


def noise_reason(claim_type="claim_type", first_tags="claim_classification_1", relevancy="relevancy_score", threshold: float = 0.3) -> Column:
    first = as_col(first_tags)
    return case(
        (F.trim(text_of(claim_type)) == "None", "claim_type_none"),
        (first.isNull() | (F.size(first) == 0), "empty_claim_classification_1"),
        (below(relevancy, threshold), "low_relevancy"),
    )


def is_caption(heading="section_heading", claim="claim") -> Column:
    starts = F.trim(F.lower(text_of(claim)))
    return contains_any(F.lower(text_of(heading)), C.CAPTION_HEADINGS) | F.array_contains(
        F.transform(lit_array(C.CAPTION_PREFIXES), lambda p: F.startswith(starts, p)), True)


def is_expectation(claim="claim", phrases: Sequence[str] = C.EXPECTATION_PHRASES) -> Column:
    return contains_any(F.lower(text_of(claim)), phrases)


def is_boilerplate(category="semantic_category", relevancy="relevancy_score", threshold: float = 0.5) -> Column:
    return (F.lower(F.trim(text_of(category))) == "method") & below(relevancy, threshold)


def bucket(route: str, claim_type="claim_type", tags="tags") -> Column:
    """First rule of the route that fits the claim type and tag set; null when none does."""
    kind, tags = F.trim(text_of(claim_type)), as_col(tags)
    branches = []
    for rule in C.ROUTES[route].rules:
        cond = kind.isin(*rule.claim_types)
        if rule.any_tags:
            cond = cond & overlaps(tags, rule.any_tags)
        if rule.only_tag:
            cond = cond & (F.size(tags) == 1) & F.array_contains(tags, rule.only_tag)
        branches.append((cond, rule.bucket))
    return case(*branches)


def placement(route: str, *, claim_type="claim_type", tags="tags", first_tags="claim_classification_1", relevancy="relevancy_score",
              category="semantic_category", heading="section_heading", claim="claim", duplicate: Column | None = None) -> Column:
    """struct(bucket, reason) of one claim: structural noise, boilerplate, quality noise, then the bucket rules."""
    spec = C.ROUTES[route]
    structural = noise_reason(claim_type, first_tags, relevancy)
    chosen = bucket(route, claim_type, tags)
    noise = lambda why: F.struct(F.lit("noise").alias("bucket"), why.alias("reason"))
    kept = lambda b: F.struct(b.alias("bucket"), F.lit(None).cast("string").alias("reason"))
    out = F.when(structural.isNotNull(), noise(structural))
    if spec.quality_gates:
        if duplicate is not None:
            out = out.when(duplicate, noise(F.lit("duplicate_of_abstract")))
        out = out.when(is_boilerplate(category, relevancy), kept(F.lit("boilerplate_method")))
    out = out.when(is_caption(heading, claim), noise(F.lit("figure_table_caption")))
    if spec.quality_gates:
        out = out.when(is_expectation(claim), noise(F.lit("expectation_claim")))
    return out.when(chosen.isNull(), noise(F.lit("no_bucket"))).otherwise(kept(chosen))


def triage(claims: DataFrame, route: str, duplicate: Column | None = None, **cols) -> DataFrame:
    """Claims with their bucket (noise included) and noise reason. Row-local: no shuffle."""
    placed = claims.withColumn("_placed", placement(route, duplicate=duplicate, **cols))
    return placed.select(*claims.columns, F.col("_placed.bucket").alias("bucket"), F.col("_placed.reason").alias("noise_reason"))


def unknown_tags(claims: DataFrame, known: Sequence[str], tags="tags") -> DataFrame:
    """Tags outside the known set with their row counts."""
    return (claims.select(F.explode(F.array_except(as_col(tags), lit_array(known))).alias("tag"))
            .filter("tag <> ''").groupBy("tag").count().withColumnRenamed("count", "claims"))


def is_placeholder(claim="claim") -> Column:
    text = F.trim(text_of(claim))
    return (text == "") | F.rtrim(F.lower(text), F.lit(".")).isin(*C.PLACEHOLDER_CLAIMS)


def drop_placeholders(claims: DataFrame, claim="claim") -> DataFrame:
    return claims.filter(~is_placeholder(claim))


def valid_relevancy(relevancy="relevancy_score") -> Column:
    r = number(relevancy)
    return F.when(r.between(0.0, 1.0), r)


def relevancy_label(relevancy="relevancy_score") -> Column:
    r = number(relevancy)
    tiers = C.RELEVANCY_TIERS
    s = clamp(r, 0.0, 1.0)
    branches = [(r.isNull() | F.isnan(r), "relevancy unknown")]
    branches += [(s < upper, label) for upper, label in tiers[:-1]]
    return case(*branches, default=tiers[-1][1])


def section_class(route: str = "empirical", category="semantic_category", heading="section_heading") -> Column:
    """Own category unless blank or "other"; else the first heading class that matches."""
    own, head = F.lower(F.trim(text_of(category))), F.lower(F.trim(text_of(heading)))
    hints = C.PROTOCOL_SECTION_HINTS if route == "protocol" else C.SECTION_HINTS
    branches = [((own != "") & (own != "other"), own)]
    branches += [(contains_any(head, words), name) for name, words in hints.items()]
    return case(*branches, default="other")


def is_self_reported(section: Column, claim_type="claim_type", tags="tags") -> Column:
    kind, tags = F.trim(text_of(claim_type)), as_col(tags)
    known_type = kind.isin(*C.SELF_REPORTED_TYPES)
    return section.isin(*C.SELF_REPORTED_SECTIONS) & ((kind == "") | known_type) & F.when(
        F.size(tags) > 0, overlaps(tags, C.SELF_REPORTED_TAGS)).otherwise(known_type)


def is_self_reported_method(section: Column, tags="tags") -> Column:
    return (section == "method") | (section.isin("result", "discussion") & F.array_contains(as_col(tags), "Methodological"))


def unreferenced_summary(claim_type="claim_type", tags="tags") -> Column:
    empirical = (F.trim(text_of(claim_type)) == "Fact") & overlaps(as_col(tags), C.EMPIRICAL_UNREFERENCED_TAGS)
    return F.when(empirical, "Empirical claim with no cited references.").otherwise("No inline citations in source chunk.")


def protocol_regrade(grade: Column | str, section: Column, tags="tags") -> Column:
    """Strong or moderate support of a design or method claim counts as precedent."""
    grade, tags = as_col(grade), as_col(tags)
    design = (section == "method") | overlaps(tags, C.PROTOCOL_DESIGN_TAGS)
    return F.when(grade.isin("strong", "moderate") & design, F.when(F.array_contains(tags, "Methodological"), "established_method")
                  .otherwise("design_precedent")).otherwise(grade)


def evidence_grade(route: str, mode: str, *, n_citations: Column | str, n_usable: Column | str = "n_usable", grade: Column | str | None = None,
                   claim_type="claim_type", tags="tags", category="semantic_category", heading="section_heading") -> Column:
    """Evidence grade decision table. mode "skip" gives no model grade, mode "grade" uses the given one."""
    own = C.ROUTES[route].self_reporting
    section = section_class(route, category, heading)
    finding, method = is_self_reported(section, claim_type, tags), is_self_reported_method(section, tags)
    uncited = as_col(n_citations) == 0
    branches = []
    if own:
        branches += [(uncited & finding, "self_reported"), (uncited & method, "self_reported_method")]
    if mode == "skip":
        if not own:
            branches.append((uncited, "unreferenced"))
        return case(*branches, default="pending")
    branches.append((uncited, "unreferenced"))
    if grade is None:
        return case(*branches, default="unverifiable")
    given = as_col(grade)
    branches.append((as_col(n_usable) == 0, "unverifiable"))
    given = F.coalesce(given, F.lit("unverifiable"))
    if own:
        weak = given.isin("unsupported", "unreferenced")
        branches += [(weak & method, "self_reported_method"), (weak & finding, "self_reported")]
    if route == "protocol":
        given = protocol_regrade(given, section, tags)
    return case(*branches, default=given)


def keep_buckets(df: DataFrame, route: str, column="bucket") -> DataFrame:
    return df.filter(as_col(column).isin(*C.ROUTES[route].keep_buckets))


def claim_narrative(template: str, *, doc_name="doc_name", claim="claim", heading="section_heading", verdict="verdict", rationale="rationale",
                    relevancy="relevancy_score", grade="evidence_grade", summary="evidence_summary") -> Column:
    """Fill the eight fields of a sentence template; a placeholder left over is an error.

    As in sequential replacement, a later field fills a placeholder that an earlier value brought in.
    """
    spaced = lambda c: F.replace(c, F.lit("_"), F.lit(" "))

    def sentence(c):
        s = F.trim(text_of(c))
        s = F.when(s == "", "no rationale recorded").otherwise(s)
        return F.when(F.endswith(s, F.lit(".")), s).otherwise(F.concat(s, F.lit(".")))

    fields = [
        ("doc_name", spaced(F.trim(F.coalesce(F.nullif(as_col(doc_name), F.lit("")), F.lit("This document"))))),
        ("claim", text_of(claim)),
        ("section_heading", F.coalesce(spaced(blank_to_null(heading)), F.lit("unspecified"))),
        ("verdict", F.coalesce(spaced(F.trim(as_col(verdict))), F.lit("unknown"))),
        ("rationale", sentence(rationale)),
        ("relevancy_label", relevancy_label(relevancy)),
        ("evidence_grade", spaced(F.coalesce(F.nullif(as_col(grade), F.lit("")), F.lit("unknown")))),
        ("evidence_summary", sentence(summary)),
    ]
    out = F.lit(template)
    for name, value in fields:
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return F.when(out.rlike(r"\{[^}]+\}"), F.raise_error(F.lit("unresolved placeholder in template"))).otherwise(out)
