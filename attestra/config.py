"""Default maps, rubrics and weights.

Everything here is data and every operator takes it as a parameter; the values below are the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values: dimension -> tags ------------------------------------------------------------
DIMENSION_TAGS: dict[str, tuple[str, ...]] = {
    "scientific_rigor": ("Definitional", "Background", "Methodological", "Measurement", "Observational", "Limitation", "Replication"),
    "evidential_strength": ("Correlational", "Causal", "Comparative", "NullFinding", "Mechanistic", "Benchmark"),
    "originality": ("GapStatement", "Hypothesis", "NoveltyAssertion", "IncrementalContribution", "Refutation", "Synthesis"),
    "execution_credibility": ("Milestone", "Feasibility", "Performance", "Setback", "Roadmap", "FutureWork"),
    "financial_integrity": ("FundingSource", "BudgetAllocation", "ResourceAlignment", "IncentiveStructure", "Sustainability"),
    "governance_accountability": ("GovernanceStructure", "Decentralization", "Accountability", "LegalRegulatory"),
    "team_credibility": ("Expertise", "TrackRecord", "Affiliation"),
    "real_world_traction": ("ImpactPotential", "Adoption", "SocietalImpact", "Generalizability"),
    "cross_cutting": ("ConflictOfInterest", "Interpretive", "Predictive", "Prescriptive", "Hedge", "SourceAttribution", "Taxonomic"),
}
TAG_INDEX: dict[str, str] = {tag: dim for dim, tags in DIMENSION_TAGS.items() for tag in tags}

# ---- fixed values: rubrics and dimension weights -------------------------------------------------
ARTICLE_WEIGHTS = {
    "scientific_rigor": 0.25, "evidential_strength": 0.25, "originality": 0.20, "team_credibility": 0.10,
    "financial_integrity": 0.05, "real_world_traction": 0.10, "execution_credibility": 0.05,
}
PROPOSAL_WEIGHTS = {"scientific_grounding": 0.30, "evidential_strength": 0.25, "originality": 0.20, "funding_realism": 0.25}


@dataclass(frozen=True)
class Rubric:
    baseline: float
    red_flag: float
    concern: float
    info: float = 0.0
    floor: float = 0.1


DEFAULT_RUBRIC = Rubric(0.7, -0.15, -0.08)
ARTICLE_RUBRICS = {
    "team_credibility": Rubric(0.7, -0.20, -0.10),
    "financial_integrity": Rubric(0.7, -0.20, -0.10),
    "real_world_traction": Rubric(0.7, -0.15, -0.08),
    "execution_credibility": Rubric(0.7, -0.15, -0.08),
}
PROPOSAL_RUBRICS = {
    "scientific_grounding": Rubric(0.6, -0.20, -0.10),
    "evidential_strength": Rubric(0.6, -0.20, -0.10),
}
ARTICLE_EXCLUDED_DIMENSIONS = ("cross_cutting", "governance_accountability")
PROPOSAL_EXCLUDED_DIMENSIONS = ("cross_cutting",)
SEVERITIES = ("red_flag", "concern", "info")  # worst first


# ---- fixed values: triage routes -----------------------------------------------------------------
@dataclass(frozen=True)
class BucketRule:
    bucket: str
    claim_types: tuple[str, ...]
    any_tags: tuple[str, ...] = ()
    only_tag: str | None = None


_BOTH = ("Fact", "Assertion")


@dataclass(frozen=True)
class Route:
    name: str
    rules: tuple[BucketRule, ...]
    keep_buckets: tuple[str, ...]
    grade_weights: dict = field(default_factory=dict)
    excluded_grades: tuple[str, ...] = ()
    quality_gates: bool = False  # expectation gate, boilerplate bucket and abstract duplicates
    self_reporting: bool = False


_METHOD_RULES = (BucketRule("methodological", _BOTH, ("Methodological",)), BucketRule("methodological", _BOTH, only_tag="Benchmark"))
_BASE_GRADES = {"strong": 1.0, "moderate": 0.8, "weak": 0.5, "unverifiable": 0.4, "unsupported": 0.25, "pending": 0.3}

ROUTES = {
    "empirical": Route(
        "empirical",
        (
            BucketRule("empirical", ("Fact",), ("Causal", "Correlational", "Comparative", "Mechanistic", "Performance", "Benchmark", "Measurement", "Observational", "NullFinding", "Replication")),
            BucketRule("empirical", ("Assertion",), ("Causal", "Correlational", "Comparative", "Mechanistic", "Performance", "Observational")),
            *_METHOD_RULES,
            BucketRule("aspirational", ("Roadmap",)),
            BucketRule("aspirational", _BOTH, ("Hypothesis", "NoveltyAssertion", "FutureWork", "Roadmap", "Feasibility", "ImpactPotential", "GapStatement")),
            BucketRule("contextual", _BOTH, ("Definitional", "Background", "Synthesis", "SourceAttribution")),
            BucketRule("contextual", ("Assertion",), ("Interpretive", "Prescriptive", "Hedge")),
        ),
        ("empirical", "methodological", "contextual", "aspirational"),
        {**_BASE_GRADES, "unreferenced": 0.35},
        ("self_reported", "self_reported_method"),
        True,
        True,
    ),
    "protocol": Route(
        "protocol",
        (
            BucketRule("design_specification", ("Fact",), ("Causal", "Correlational", "Comparative", "Mechanistic", "Performance", "Benchmark", "Measurement", "Observational", "NullFinding", "Replication")),
            BucketRule("design_specification", ("Assertion",), ("Causal", "Correlational", "Comparative", "Mechanistic", "Performance", "Observational")),
            *_METHOD_RULES,
            BucketRule("background_rationale", ("Roadmap",), ("GapStatement",)),
            BucketRule("background_rationale", _BOTH, ("Background", "Synthesis", "SourceAttribution")),
            BucketRule("aspirational", ("Roadmap",)),
            BucketRule("aspirational", _BOTH, ("Hypothesis", "NoveltyAssertion", "FutureWork", "Roadmap", "Feasibility", "ImpactPotential")),
            BucketRule("contextual", _BOTH, ("Definitional",)),
            BucketRule("contextual", ("Assertion",), ("Interpretive", "Prescriptive", "Hedge")),
        ),
        ("design_specification", "methodological", "background_rationale", "contextual", "aspirational"),
        {**_BASE_GRADES, "unreferenced": 0.3, "design_precedent": 0.85, "established_method": 0.9},
    ),
    "theoretical": Route(
        "theoretical",
        (
            BucketRule("thesis_argument", _BOTH, ("Causal", "Correlational", "Comparative", "Mechanistic", "Performance", "Observational", "Interpretive")),
            BucketRule("synthesis", _BOTH, ("Background", "Synthesis", "SourceAttribution")),
            *_METHOD_RULES,
            BucketRule("aspirational", ("Roadmap",)),
            BucketRule("aspirational", _BOTH, ("Hypothesis", "NoveltyAssertion", "FutureWork", "Roadmap", "Feasibility", "ImpactPotential", "GapStatement")),
            BucketRule("contextual", _BOTH, ("Definitional",)),
            BucketRule("contextual", ("Assertion",), ("Prescriptive", "Hedge")),
        ),
        ("thesis_argument", "synthesis", "methodological", "contextual", "aspirational"),
        {**_BASE_GRADES, "unreferenced": 0.35, "overclaim": 0.2},
    ),
}
DEFAULT_GRADE_WEIGHT = 0.3

# ---- fixed values: claim gates -------------------------------------------------------------------
PLACEHOLDER_CLAIMS = ("no scientific claims identified in the text", "no scientific claims identified")
CAPTION_HEADINGS = ("figure", "table")
CAPTION_PREFIXES = ("figure", "table", "in all ")
EXPECTATION_PHRASES = (
    "is expected to", "are expected to", "was expected to", "were expected to",
    "is anticipated to", "are anticipated to", "should result in", "should show",
)
KEY_MESSAGE_HEADINGS = ("key message", "key finding")
RELEVANCY_TIERS = ((0.2, "low relevancy"), (0.4, "slightly relevant"), (0.6, "moderately relevant"), (0.8, "very relevant"), (1.0, "extremely relevant"))

# ---- fixed values: section classes and self-reporting --------------------------------------------
SECTION_HINTS = {
    "abstract": ("abstract", "key messages"),
    "method": ("method", "materials", "protocol", "husbandry", "toxicity", "sequencing", "replication", "preparation",
               "experimental", "sample preparation", "data processing"),
    "result": ("result", "finding", "efficacy", "differentially expressed", "enrichment", "transcriptomic", "vs.", "versus",
               "control", "treated", "exposed", "induced", "affected"),
    "discussion": ("discussion", "interpretation", "implications", "conclusion"),
}
PROTOCOL_SECTION_HINTS = {
    "method": ("method", "materials", "protocol", "procedure", "design", "statistical", "analysis plan", "sample size",
               "randomization", "blinding", "measurement", "outcome"),
}
SELF_REPORTED_SECTIONS = ("abstract", "result", "discussion")
SELF_REPORTED_TAGS = ("Observational", "Measurement", "Causal", "Comparative", "Correlational", "Methodological", "Benchmark", "Performance")
SELF_REPORTED_TYPES = ("Fact", "Interpretation", "Result", "Assertion")
EMPIRICAL_UNREFERENCED_TAGS = ("Causal", "Correlational", "Mechanistic", "Performance")
PROTOCOL_DESIGN_TAGS = ("Methodological", "Measurement", "Benchmark", "Performance")

# ---- fixed values: project lines -----------------------------------------------------------------
DAO_CATEGORIES = ("research_output_quality", "scientific_grounding", "execution_competence", "team_credibility", "mission_clarity", "governance_tokenomics")
DAO_WEIGHTS = {
    "research_output_quality": 0.30, "scientific_grounding": 0.25, "execution_competence": 0.20,
    "team_credibility": 0.05, "mission_clarity": 0.10, "governance_tokenomics": 0.10,
}
FAVORABLE_VERDICTS = ("valid", "positive")
UNFAVORABLE_VERDICTS = ("invalid", "negative")
SOURCE_WEIGHTS = {
    "onchain_fact": 1.5, "pdf": 1.3, "text_doc": 1.2, "video_transcript": 1.0, "crawl_md": 1.0,
    "image_caption": 0.7, "video_frame": 0.7,
}
LINE_TYPE_WEIGHTS = {
    "research_output_quality": {"claim": 0.8, "feature": 1.5, "mission": 0.5, "fact": 1.2},
    "scientific_grounding": {"claim": 1.5, "feature": 0.7, "mission": 0.8, "fact": 0.6},
    "execution_competence": {"claim": 0.7, "feature": 1.2, "mission": 0.5, "fact": 1.5},
    "team_credibility": {"claim": 0.5, "feature": 0.5, "mission": 0.5, "fact": 1.5},
    "mission_clarity": {"claim": 0.7, "feature": 0.7, "mission": 1.5, "fact": 0.7},
    "governance_tokenomics": {"claim": 0.6, "feature": 0.7, "mission": 0.5, "fact": 1.5},
}


def tag_table(spark: SparkSession, tag_index: dict[str, str] = TAG_INDEX) -> DataFrame:
    """The tag map as a two-column dimension table."""
    return spark.createDataFrame(list(tag_index.items()), "tag string, dimension string")


def weight_table(spark: SparkSession, weights: dict[str, float]) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, weight double")
