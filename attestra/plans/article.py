"""Article route end to end: claims to published category scores, for all documents at once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra import config as C
from attestra.operators import gates as G
from attestra.operators import scoring as S


def article_scores(claims: DataFrame, findings: DataFrame, works: DataFrame, review: DataFrame, route: str = "empirical", doc: str = "doc_id",
                   tags: str = "tags", first_tags: str = "claim_classification_1", tag_index: Mapping[str, str] = C.TAG_INDEX) -> DataFrame:
    """Evidence scores of the kept buckets, originality and rubric scores merged by precedence; long form with rationales.

    claims(doc, claim, verdict, tags, evidence_grade, ...), findings(doc, dimension, severity), works(doc, similarity),
    review(doc, dimension, score, rationale).
    """
    members = S.claims_by_dimension(G.drop_placeholders(claims), tag_index, tags)
    kept = G.keep_buckets(G.triage(members, route, tags=tags, first_tags=first_tags), route)
    evidence = S.evidence_scores(kept, route, (doc, "dimension"))
    novel = S.originality(works, (doc,)).select(doc, F.lit("originality").alias("dimension"), F.col("originality_score").alias("score"))
    rubric = S.rubric_scores(findings, (doc, "dimension"), scored=evidence)
    return S.merge_scores([evidence, novel, rubric], review, doc)


def article_reviews(scores: DataFrame, doc: str = "doc_id", weights: Mapping[str, float] = C.ARTICLE_WEIGHTS) -> DataFrame:
    """Composite percent per document over the categories that have a rationale."""
    filled = scores.filter(F.trim("rationale") != "")
    return S.composite(filled, weights, (doc,)).withColumn("composite_score", S.ceil_percent("composite"))
