"""The article route as one query."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestra.catalog.registry import query
from attestra.fixtures import claims, table, view
from attestra.plans.article import article_reviews, article_scores


@query("article_route")
def _(spark, d):
    c = claims(spark, d).withColumn("doc_id", F.col("claim_id") % 50)
    conv = table(spark, d, "conversations")
    dims = F.element_at(F.array(*[F.lit(x) for x in ("team_credibility", "scientific_rigor", "originality", "evidential_strength")]), (F.col("turn") % 4 + 1).cast("int"))
    review = conv.groupBy(F.col("conv_id").alias("doc_id"), dims.alias("dimension")).agg(F.min("text").alias("rationale"), F.lit(0.5).alias("score"))
    scores = article_scores(c, view(spark, d, "findings"), view(spark, d, "works"), review, first_tags="tags")
    return article_reviews(scores).select("doc_id", "composite", "composite_score")
