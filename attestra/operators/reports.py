"""Audit documents as line tables: every line has a section, an order and a detail size; documents are joined at the very end."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions.columns import lit_array, text_of
from attestra.functions.text import public_label, severity_rank, short_doi, truncate, verdict_mark
from attestra.operators.lines import audit_filter
from attestra.operators.ranking import top_k
from attestra.operators.scoring import grade_counts


@dataclass(frozen=True)
class AuditDetail:
    claim_chars: int = 220
    observation_chars: int = 260
    works: int = 25
    self_reported: bool = False
    screener_info: bool = True
    supported: bool = True


def _line(df: DataFrame, key: str, section: int, order: Sequence, text: Column) -> DataFrame:
    return df.select(key, F.lit(section).alias("section"), F.concat_ws("|", *order).alias("ord"), text.alias("line"))


def _pad(c) -> Column:
    return F.lpad((F.col(c) if isinstance(c, str) else c).cast("string"), 12, "0")


def article_audit(key: str, categories: DataFrame, claims: DataFrame, findings: DataFrame, works: DataFrame, detail: AuditDetail = AuditDetail()) -> DataFrame:
    """Lines of the article audit: category table, grade counts, claim trace, findings, top works."""
    cat = _line(categories, key, 1, ["dimension"], F.concat(F.lit("| "), "dimension", F.lit(" | "), F.col("score").cast("string"), F.lit(" |")))
    grades = grade_counts(claims, (key, "dimension", "bucket"))
    g = _line(grades, key, 2, ["dimension", "bucket", _pad(F.lit(10**11) - F.col("claims")), "grade"], F.concat_ws(" · ", F.col("dimension"), "bucket", F.concat("grade", F.lit(": "), F.col("claims").cast("string"))))
    shown = audit_filter(claims, detail.self_reported, not detail.supported)
    trace = _line(shown, key, 3, ["dimension", _pad("claim_id")], F.concat(F.lit("- ["), text_of("evidence_grade"), F.lit("] "), truncate("claim", detail.claim_chars)))
    f = findings if detail.screener_info else findings.filter("severity <> 'info'")
    found = _line(f, key, 4, ["dimension", severity_rank("severity").cast("string"), _pad("seq")], F.concat(F.lit("- "), "severity", F.lit(": "), truncate("observation", detail.observation_chars)))
    top = top_k(works, [key], [F.desc("similarity"), "work_id"], detail.works)
    w = _line(top, key, 5, [_pad("rank")], F.concat_ws(" · ", F.concat(F.lit("- "), F.col("similarity").cast("string")), F.col("openalex_id"), short_doi("doi")))
    return cat.unionByName(g).unionByName(trace).unionByName(found).unionByName(w)


def proposal_audit(key: str, provenance: DataFrame, categories: DataFrame, findings: DataFrame, works: DataFrame, funding: DataFrame, detail: AuditDetail = AuditDetail()) -> DataFrame:
    """Lines of the proposal audit: provenance, scores, findings by dimension and severity, works, funding."""
    p = _line(provenance, key, 0, ["name"], F.concat(F.lit("- "), "name", F.lit(": "), "value"))
    body = article_audit(key, categories, findings.select(key, F.lit(None).cast("string").alias("dimension"), F.lit(None).cast("string").alias("bucket"), F.lit(None).cast("string").alias("evidence_grade"),
                                                          F.lit(None).cast("string").alias("claim"), F.lit(None).cast("long").alias("claim_id")).filter("false"), findings, works, detail)
    money = _line(funding, key, 6, [F.lit("0")], F.concat(F.lit("- funded "), F.col("percent_funded").cast("string"), F.lit("%, days left "), text_of("days_remaining")))
    return p.unionByName(body).unionByName(money)


def dao_audit(lines: DataFrame, chunks: DataFrame, categories: DataFrame, key: str, per_source: int = 12) -> DataFrame:
    """Lines of a project audit: at-a-glance counts, category table, sources with their top lines."""
    glance = _line(lines.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct("source_kind").alias("s")), key, 0, [F.lit("0")],
                   F.concat(F.lit("- lines "), F.col("n").cast("string"), F.lit(", source kinds "), F.col("s").cast("string")))
    cat = _line(categories, key, 1, ["category"], F.concat(F.lit("| "), "category", F.lit(" | "), text_of("score"), F.lit(" |")))
    rank = F.array_position(lit_array(("valid", "positive", "invalid", "negative", "inconclusive", "neutral")), F.col("verdict"))
    label = lines.withColumn("label", public_label())
    top = top_k(label, [key, "label"], [rank, "line_id"], per_source)
    src = _line(top, key, 2, ["label", _pad("rank")], F.concat(verdict_mark("verdict"), F.lit(" "), truncate("text", 200)))
    more = _line(top.filter("rank = 1 AND omitted > 0"), key, 2, ["label", F.lit("999999999999")], F.concat(F.lit("… "), F.col("omitted").cast("string"), F.lit(" more from "), "label"))
    return glance.unionByName(cat).unionByName(src).unionByName(more)


def compound_audit(key: str, coverage: DataFrame, tags: DataFrame, units: DataFrame, detail: AuditDetail = AuditDetail()) -> DataFrame:
    """Lines of a compound or combination audit: source coverage, tag counts, evidence units."""
    c = _line(coverage, key, 1, ["source"], F.concat(F.lit("- "), "source", F.when(F.col("present"), ": yes").otherwise(": no")))
    t = _line(tags, key, 2, ["tag"], F.concat(F.lit("- "), "tag", F.lit(": "), F.col("rows").cast("string")))
    u = _line(units, key, 3, [_pad("unit_no")], F.concat(F.lit("- "), "unit_id", F.lit(" "), truncate("snippet", detail.claim_chars)))
    return c.unionByName(t).unionByName(u)


def assemble(lines: DataFrame, key: str) -> DataFrame:
    """One text per document, its lines in order. The size of a row is that of the document."""
    ordered = F.array_sort(F.collect_list(F.struct("section", "ord", "line")))
    return lines.groupBy(key).agg(F.array_join(F.transform(ordered, lambda s: s["line"]), "\n").alias("text"))


def tightening(steps: int = 12, first: AuditDetail = AuditDetail()) -> list[AuditDetail]:
    """The details tried one after the other: drop screener info, then supported claims, then shorten everything."""
    out = [first, replace(first, screener_info=False), replace(first, screener_info=False, supported=False)]
    while len(out) < steps:
        last = out[-1]
        out.append(replace(last, claim_chars=max(80, last.claim_chars - 40), observation_chars=max(80, last.observation_chars - 40), works=max(3, last.works - 2)))
    return out[:steps]


def fit_audit(build, key: str, max_bytes: int = 120 * 1024, steps: Sequence[AuditDetail] | None = None) -> DataFrame:
    """The loosest step whose text fits the byte limit, else the last one.

    Sizes are summed per (document, step) before any text is put together; only the chosen step's lines are joined.
    """
    steps = list(steps or tightening())
    all_lines = None
    for i, d in enumerate(steps):
        part = build(d).withColumn("step", F.lit(i))
        all_lines = part if all_lines is None else all_lines.unionByName(part)
    size = all_lines.groupBy(key, "step").agg((F.sum(F.octet_length("line") + 1) - 1).alias("bytes"))
    chosen = size.groupBy(key).agg(F.coalesce(F.min(F.when(F.col("bytes") <= max_bytes, F.col("step"))), F.max("step")).alias("step"))
    return assemble(all_lines.join(chosen, [key, "step"]), key).join(chosen, key)


def evidence_block(lines: DataFrame, by: Sequence[str], order: Sequence, works: str = "retrieved_works", k: int = 60, cited: int = 4) -> DataFrame:
    """Up to k lines of a category, each with up to four cited works, as one text."""
    top = top_k(lines, by, order, k)
    refs = F.array_join(F.transform(F.slice(F.col(works), 1, cited), lambda w: F.concat(F.lit("    · "), w["work_id"], F.lit(" "), text_of(w["title"]))), "\n")
    line = F.concat_ws("\n", F.concat(F.col("rank").cast("string"), F.lit(". ["), "verdict", F.lit("] "), F.substring("text", 1, 300)), F.nullif(refs, F.lit("")))
    return top.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("l")))), lambda s: s["l"]), "\n").alias("block"), F.max("omitted").alias("omitted"))

