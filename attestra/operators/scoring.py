"""Scores: weighted, shrunken and penalty-based, per dimension or category, and their composites."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra import config as C
from attestra.functions.columns import as_col, clamp, lit_array, lookup, text_of
from attestra.operators.gates import number, valid_relevancy


def claims_by_dimension(claims: DataFrame, tag_index: Mapping[str, str] = C.TAG_INDEX, tags="tags") -> DataFrame:
    """One row per claim and distinct dimension. The tag map is a small literal, so nothing is shuffled."""
    dims = F.array_compact(F.array_distinct(F.transform(as_col(tags), lambda t: lookup(tag_index, t))))
    return claims.withColumn("dimension", F.explode(dims))


def dimension_scores(members: DataFrame, by: Sequence[str] = ("dimension",), gamma: float = 0.5, prior: float = 5.0,
                     verdict="verdict", relevancy="relevancy_score") -> DataFrame:
    """Support ratio times mean relevancy to the gamma, shrunk towards one half by member count."""
    gamma = 0.5 if gamma <= 0 else min(gamma, 1.0)
    v = as_col(verdict)
    agg = members.groupBy(*by).agg(
        F.count("*").alias("members"),
        F.count_if(v == "supported").alias("supported"),
        F.count_if(v == "unsupported").alias("unsupported"),
        F.avg(valid_relevancy(relevancy)).alias("mean_relevancy"),
    )
    decided = F.col("supported") + F.col("unsupported")
    ratio = F.when(decided > 0, F.col("supported") / decided)
    blended = ratio * F.coalesce(F.pow("mean_relevancy", F.lit(gamma)), F.lit(1.0))
    pull = F.col("members") / (F.col("members") + F.lit(prior)) if prior > 0 else F.lit(1.0)
    score = blended * pull + F.lit(0.5) * (1 - pull)
    return agg.select(*by, "members", "supported", "unsupported",
                      F.round("mean_relevancy", 6).alias("mean_relevancy"),
                      F.when(ratio.isNotNull(), F.round(clamp(score, 0.0, 1.0), 4)).alias("score"))


def triage_stats(placed: DataFrame, route: str, by: Sequence[str] = ("dimension",)) -> DataFrame:
    """Bucket counts per group, and a grand total row with null keys."""
    extra = ("boilerplate_method",) if C.ROUTES[route].quality_gates else ()
    buckets = C.ROUTES[route].keep_buckets + extra + ("noise",)
    return placed.rollup(*by).agg(
        F.count("*").alias("total"), *[F.count_if(F.col("bucket") == b).alias(b) for b in buckets],
        F.grouping_id().alias("_level"),
    ).filter(F.col("_level").isin(0, 2 ** len(by) - 1)).drop("_level")


def dominance_flag(placed: DataFrame, by: Sequence[str] = (), min_total: int = 5) -> DataFrame:
    n = lambda b: F.count_if(F.col("bucket") == b)
    agg = placed.groupBy(*by).agg(n("empirical").alias("empirical"), n("contextual").alias("contextual"), n("aspirational").alias("aspirational"))
    soft = F.col("contextual") + F.col("aspirational")
    return agg.withColumn("dominated", (soft + F.col("empirical") >= min_total) & (soft > F.col("empirical")))


def evidence_scores(claims: DataFrame, route: str, by: Sequence[str] = ("dimension",), grade="evidence_grade", relevancy="relevancy_score") -> DataFrame:
    """Grade weights averaged by relevancy. A relevancy of zero, null or junk counts as one half."""
    spec = C.ROUTES[route]
    g = F.lower(F.trim(F.coalesce(F.nullif(as_col(grade), F.lit("")), F.lit("pending"))))
    weight = F.coalesce(lookup(spec.grade_weights, g), F.lit(C.DEFAULT_GRADE_WEIGHT))
    rel = clamp(F.coalesce(F.nullif(number(relevancy), F.lit(0.0)), F.lit(0.5)), 0.0, 1.0)
    counted = ~g.isin(*spec.excluded_grades) if spec.excluded_grades else F.lit(True)
    total = F.sum(F.when(counted, rel))
    return claims.groupBy(*by).agg(
        F.count("*").alias("claim_count"),
        F.coalesce(F.round(F.sum(F.when(counted, weight * rel)) / F.nullif(total, F.lit(0.0)), 4), F.lit(0.5)).alias("score"),
    )


def grade_counts(claims: DataFrame, by: Sequence[str] = ("dimension",), grade="evidence_grade") -> DataFrame:
    g = F.lower(F.trim(F.coalesce(F.nullif(as_col(grade), F.lit("")), F.lit("unknown"))))
    return claims.groupBy(*by, g.alias("grade")).agg(F.count("*").alias("claims"))


def grade_rollup(claims: DataFrame, by: Sequence[str] = ("dimension",), grade="evidence_grade") -> DataFrame:
    g = as_col(grade)
    return claims.groupBy(*by).agg(
        F.count_if(g.isin("strong", "moderate")).alias("supported_claims"),
        F.count_if(g.isin("self_reported", "self_reported_method")).alias("self_reported_claims"),
        F.count_if(g.isin("unsupported", "unreferenced")).alias("unsupported_claims"),
    )


def _rubric_column(rubrics: Mapping[str, C.Rubric], default: C.Rubric, attr: str, dim: Column) -> Column:
    table = {k: float(getattr(r, attr)) for k, r in rubrics.items()}
    base = F.lit(float(getattr(default, attr)))
    return F.coalesce(lookup(table, dim), base) if table else base


def rubric_scores(findings: DataFrame, by: Sequence[str] = ("doc_id", "dimension"), rubrics: Mapping[str, C.Rubric] = C.ARTICLE_RUBRICS,
                  default: C.Rubric = C.DEFAULT_RUBRIC, cap: float | None = None, scored: DataFrame | None = None, severity="severity") -> DataFrame:
    """max(floor, baseline + penalties), optionally capped above; groups already scored are left out."""
    dim, sev = F.col("dimension"), F.coalesce(as_col(severity), F.lit("info"))
    if scored is not None:
        findings = findings.join(scored.select(*by).distinct(), list(by), "left_anti")
    counts = findings.groupBy(*by).agg(*[F.count_if(sev == s).alias(f"_{s}") for s in C.SEVERITIES], F.count("*").alias("finding_count"))
    raw = _rubric_column(rubrics, default, "baseline", dim)
    for s in C.SEVERITIES:
        raw = raw + F.col(f"_{s}") * _rubric_column(rubrics, default, s, dim)
    score = F.greatest(_rubric_column(rubrics, default, "floor", dim), raw)
    if cap is not None:
        score = F.least(F.lit(cap), score)
    return counts.select(*by, "finding_count", F.round(score, 4).alias("score"))


def with_baselines(items: DataFrame, scores: DataFrame, rubrics: Mapping[str, C.Rubric], key: str) -> DataFrame:
    """Every item x rubric dimension; those without findings get the baseline."""
    base = F.explode(F.map_from_arrays(lit_array(rubrics), lit_array([r.baseline for r in rubrics.values()]))).alias("dimension", "_base")
    return (items.select(key).distinct().select(key, base).join(scores, [key, "dimension"], "left")
            .select(key, "dimension", F.coalesce("finding_count", F.lit(0)).alias("finding_count"),
                    F.coalesce("score", F.round("_base", 4)).alias("score")))


def composite(scores: DataFrame, weights: Mapping[str, float], by: Sequence[str] = (), default: float = 0.0, name="dimension",
              score="score", skip_null: bool = False) -> DataFrame:
    """Weighted mean over the present dimensions; plain mean if none carries weight; a default if empty."""
    if skip_null:
        scores = scores.filter(as_col(score).isNotNull())
    w = F.coalesce(lookup(weights, as_col(name)), F.lit(0.0))
    w = F.when(w > 0, w)
    s = as_col(score)
    return scores.groupBy(*by).agg(F.coalesce(F.round(F.sum(s * w) / F.sum(w), 4), F.round(F.avg(s), 4), F.lit(default)).alias("composite"))


def composite_dao(scores: DataFrame, weights: Mapping[str, float] = C.DAO_WEIGHTS, by: Sequence[str] = (), name="category", score="score") -> DataFrame:
    """Weighted mean of the scores present, rounded up; null where nothing carries weight."""
    s = as_col(score)
    w = F.when(s.isNotNull(), F.coalesce(lookup(weights, as_col(name)), F.lit(0.0)))
    return scores.groupBy(*by).agg(F.ceil(F.round(F.sum(s * w) / F.nullif(F.sum(w), F.lit(0.0)), 9)).alias("composite"))


def line_weights(lines: DataFrame, source_weights: Mapping[str, float] = C.SOURCE_WEIGHTS,
                 type_weights: Mapping[str, Mapping[str, float]] = C.LINE_TYPE_WEIGHTS) -> DataFrame:
    """weight = source weight x line type weight of the category, each 1.0 when unknown."""
    by_type = {f"{cat}|{kind}": w for cat, kinds in type_weights.items() for kind, w in kinds.items()}
    source = F.coalesce(lookup(source_weights, F.col("source_kind")), F.lit(1.0))
    kind = F.coalesce(lookup(by_type, F.concat_ws("|", "category", "line_type")), F.lit(1.0))
    return lines.withColumn("weight", F.round(source * kind, 4))


def category_scores(lines: DataFrame, by: Sequence[str] = ("category",), favorable: Sequence[str] = C.FAVORABLE_VERDICTS,
                    unfavorable: Sequence[str] = C.UNFAVORABLE_VERDICTS, weight="effective_weight", cluster="cluster_id", source="source_path") -> DataFrame:
    """Weighted and raw favorable shares in percent (half-even), with line, cluster and source counts."""
    good, bad = F.col("verdict").isin(*favorable), F.col("verdict").isin(*unfavorable)
    w = as_col(weight)
    per_source = lines.groupBy(*by, source, cluster).agg(  # partial sums first, distinct counts over the small result
        F.count("*").alias("n"), F.count_if(good).alias("g"), F.count_if(bad).alias("b"),
        F.sum(F.when(good, w)).alias("gw"), F.sum(F.when(bad, w)).alias("bw"))
    agg = per_source.groupBy(*by).agg(
        F.sum("n").alias("line_count"), F.count_distinct(cluster).alias("cluster_count"), F.count_distinct(source).alias("source_count"),
        F.sum("g").alias("favorable"), F.sum("b").alias("unfavorable"),
        F.coalesce(F.sum("gw"), F.lit(0.0)).alias("_gw"), F.coalesce(F.sum("bw"), F.lit(0.0)).alias("_bw"))
    pct = lambda a, b: F.bround(F.round(F.lit(100.0) * a / F.nullif(a + b, F.lit(0) * a), 8), 0).cast("int")
    return agg.select(*by, "line_count", "cluster_count", "source_count", "favorable", "unfavorable",
                      F.round("_gw", 4).alias("favorable_weight"), F.round("_bw", 4).alias("unfavorable_weight"),
                      pct(F.col("_gw"), F.col("_bw")).alias("score"), pct(F.col("favorable"), F.col("unfavorable")).alias("raw_score"))


def verdict_totals(lines: DataFrame, by: Sequence[str] = ("category",), weight="effective_weight") -> DataFrame:
    return lines.groupBy(*by, "verdict").agg(F.count("*").alias("lines"), F.round(F.sum(as_col(weight)), 4).alias("weight"))


def publishable(scores: DataFrame, score="score", rationale="rationale") -> DataFrame:
    """Categories with a rationale only; score as a ceiling percent."""
    text = F.trim(text_of(rationale))
    return scores.filter(text != "").withColumn(rationale, text).withColumn(score, ceil_percent(score))


def ceil_percent(score) -> Column:
    return F.ceil(F.round(as_col(score), 4) * 100).cast("int")


def originality(works: DataFrame, by: Sequence[str] = ("doc_id",), missing: float = 0.10, similarity="similarity") -> DataFrame:
    """1 - mean similarity over the related works."""
    mean = F.avg(F.coalesce(as_col(similarity), F.lit(missing)))
    return works.groupBy(*by).agg(F.count("*").alias("works"), F.round(mean, 4).alias("mean_similarity"), F.round(1 - mean, 4).alias("originality_score"))


def originality_of(items: DataFrame, works: DataFrame, key: str, empty: float = 1.0) -> DataFrame:
    """Originality of every item; items without works get the given score (1.0 for articles, 0.8 for proposals)."""
    return (items.select(key).distinct().join(originality(works, (key,)), key, "left")
            .select(key, F.coalesce("works", F.lit(0)).alias("works"), F.coalesce("mean_similarity", F.lit(0.0)).alias("mean_similarity"),
                    F.coalesce("originality_score", F.lit(empty)).alias("originality_score")))


def merge_scores(parts: Sequence[DataFrame], review: DataFrame, key: str = "doc_id", excluded: Sequence[str] = C.ARTICLE_EXCLUDED_DIMENSIONS) -> DataFrame:
    """Category scores by precedence (earlier part wins), rationale from the review; leftovers keep the review's own score."""
    own = review.filter(F.trim(text_of("rationale")) != "").select(key, "dimension", F.coalesce("score", F.lit(0.5)).alias("score"))
    tagged = [p.select(key, "dimension", "score", F.lit(i).alias("_rank")) for i, p in enumerate([*parts, own])]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t)
    best = (union.filter(~F.col("dimension").isin(*excluded)).groupBy(key, "dimension")
            .agg(F.min_by(F.struct("score", "_rank"), "_rank").alias("_best")))
    return (best.join(review.select(key, "dimension", "rationale"), [key, "dimension"], "left")
            .select(key, "dimension", F.col("_best.score").alias("score"), F.col("_best._rank").alias("source_rank"),
                    F.coalesce("rationale", F.lit("")).alias("rationale")))


def funding_snapshot(df: DataFrame, now: str | Column, raised="raised", goal="goal", start="start_date", end="end_date") -> DataFrame:
    """Percent funded, days total and left, daily velocity and whether the goal is in reach.

    No row for goal <= 0; a missing date counts as now; an unreadable date gives null days.
    """
    now = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    n = now.cast("double")
    parsed = lambda c: F.when(F.coalesce(as_col(c).cast("string"), F.lit("")) == "", n).otherwise(
        as_col(c).try_cast("timestamp").cast("double"))
    s, e = parsed(start), parsed(end)
    readable = s.isNotNull() & e.isNotNull()
    g, r = as_col(goal).cast("double"), F.coalesce(as_col(raised).cast("double"), F.lit(0.0))
    total = F.greatest((e - s) / 86400.0, F.lit(1.0))
    elapsed = F.greatest((n - s) / 86400.0, F.lit(0.0))
    left = F.greatest((e - n) / 86400.0, F.lit(0.0))
    velocity = r / F.greatest(elapsed, F.lit(1.0))
    return df.filter(g > 0).withColumns({
        "amount_raised": F.round(r, 2), "percent_funded": F.round(r / g * 100, 1),
        "days_total": F.when(readable, F.bround(total, 0).cast("int")), "days_remaining": F.when(readable, F.bround(left, 0).cast("int")),
        "daily_velocity": F.when(readable, F.round(velocity, 2)), "on_track": F.when(readable, velocity * total >= g),
    })
