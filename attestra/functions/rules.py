"""Rule text of material rows, relevance overrides, export predicates and topic labels."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from attestra.functions.columns import as_col, case, lookup, text_of

# ---- fixed values: source groups, tags, priorities ------------------------------------------------
BACKGROUND_SOURCES = (
    "compound_name", "discover_metadata", "discover_round_meta", "europe_pmc_query_stats", "clinical_trials_meta", "kegg_summary",
    "chembl_molecule", "pubchem_bioassays_meta", "openalex_grounding_meta", "openalex_risk_meta",
)
ASSAY_SOURCES = ("chembl_mechanism", "chembl_activity", "pubchem_bioassay")
LABEL_SOURCES = ("openfda_faers", "openfda_drug_label")
LONGEVITY_TAGS = ("direct_longevity", "indirect_longevity_mechanism")
RISK_TAGS = ("toxicity_or_adverse_signal", "interaction_or_combination_risk", "direct_human_safety", "pharmacology_risk_theoretical")
RISK_PRIORITY = {
    "not_relevant": 0, "no_risk_signal": 0, "pharmacology_risk_theoretical": 1, "toxicity_or_adverse_signal": 2,
    "direct_human_safety": 3, "interaction_or_combination_risk": 4,
}
IGNORED_KEYS = ("api_versions", "failures", "meta", "query", "query_names", "source_queries", "search_term", "search_terms")

# ---- fixed values: word patterns (whole words, any case) ------------------------------------------
PATTERNS = {
    "direct": r"\b(lifespan|life span|longevity|healthspan|health span|anti[- ]?aging|antiaging|chronological aging|replicative aging|age[- ]related decline)\b",
    "indirect": r"\b(senescence|sasp|autophagy|mitochondri|mTOR|AMPK|sirtuin|SIRT\d*|NAD\+?|inflammaging|oxidative stress|reactive oxygen species|proteostasis|telomere|insulin/IGF|IGF-?1|stem cell|immune aging)\b",
    "aging_context": r"\b(lifespan|life span|longevity|healthspan|health span|anti[- ]?aging|antiaging|chronological aging|replicative aging|age[- ]related|cellular senescence|frailty|geriatric|healthspan extension|lifespan extension)\b",
    "oncology": r"\b(cancer|carcinoma|tumor|tumour|oncolog|neoplasm|malignan|cytotoxic|antitumor|anti-tumor|chemotherapy|radiotherapy|xenograft|cell lines?|hepatoma|melanoma|glioma|leukemia|NSCLC|breast cancer|colorectal)\b",
    "interaction": r"\b(co-?administration|co-?administered|co-?treatment|combination therapy|combined with|drug interaction|drug-drug interaction|synerg|potentiat|CYP\d|cytochrome p450|P-?gp|p-glycoprotein|transporter|QT|qtc|torsade|anticoagul|bleeding|platelet|warfarin|statin)\b",
    "combination": r"\b(combined with|combination|co-?treatment|co-?administered|co-?administration)\b[\s\S]{0,160}\b(chemotherapy|radiotherapy|cisplatin|CDDP|doxorubicin|platinum)\b|\b(chemotherapy|radiotherapy|cisplatin|CDDP|doxorubicin|platinum)\b[\s\S]{0,160}\b(combined with|combination|co-?treatment|co-?administered|co-?administration)\b",
    "human_safety": r"\b(label|boxed warning|contraindicat|warning|precaution|adverse reaction|adverse event|clinical safety|tolerability|pregnancy|lactation|dose adjustment|hepatic impairment|renal impairment)\b",
    "toxicity": r"\b(toxicity|toxic|cytotoxic|hepatotoxic|nephrotoxic|cardiotoxic|neurotoxic|genotoxic|teratogenic|mutagenic|adverse event|adverse reaction|side effect|side-effect|death|fatal|dose-limiting|organ toxicity|FAERS|surveillance)\b",
}
# Letters in lower case of which a text must hold one from each group for its pattern to match; searched before the pattern.
STEMS = {
    "direct": (("lifespan", "life span", "longevity", "healthspan", "health span", "aging", "decline"),),
    "indirect": (("senescence", "sasp", "autophagy", "mitochondri", "mtor", "ampk", "sirt", "nad", "aging", "oxidative", "oxygen", "proteostasis", "telomere", "insulin", "igf", "stem cell"),),
    "aging_context": (("lifespan", "life span", "longevity", "healthspan", "health span", "aging", "related", "senescence", "frailty", "geriatric"),),
    "oncology": (("cancer", "carcinoma", "tumor", "tumour", "oncolog", "neoplasm", "malignan", "cytotoxic", "therapy", "xenograft", "cell line", "hepatoma", "melanoma", "glioma", "leukemia",
                  "nsclc", "colorectal"),),
    "interaction": (("administ", "treatment", "combination", "combined", "interaction", "synerg", "potentiat", "cyp", "cytochrome", "gp", "p-glycoprotein", "transporter", "qt", "torsade",
                     "anticoagul", "bleeding", "platelet", "warfarin", "statin"),),
    "combination": (("combined", "combination", "treatment", "administ"), ("therapy", "cisplatin", "cddp", "doxorubicin", "platinum")),
    "human_safety": (("label", "warning", "contraindicat", "precaution", "adverse", "safety", "tolerability", "pregnancy", "lactation", "dose", "impairment"),),
    "toxicity": (("toxic", "teratogenic", "mutagenic", "adverse", "side", "death", "fatal", "dose", "faers", "surveillance"),),
}
# Letters outside ASCII that an any-case search takes for ASCII ones.
FOLDED = ("\u017f", "\u0131", "\u0130")
# Topic labels per axis, first match wins.
TOPICS = {
    "longevity": (
        ("senescence_sasp", r"\b(senescence|sasp|cellular senescence|bystander)\b"),
        ("mitochondria_ros", r"\b(mitochondri|ros|reactive oxygen|oxidative stress|atp|membrane potential)\b"),
        ("autophagy_mtor", r"\b(autophagy|mTOR|AMPK|sirtuin|NAD\+?|proteostasis)\b"),
        ("immune_inflammation", r"\b(inflammaging|macrophage|immune|inflammation|cytokine|treg)\b"),
        ("metabolism", r"\b(metabolic|obesity|diabetes|atherosclerosis|nafld|metabolic syndrome)\b"),
        ("lifespan_healthspan", r"\b(lifespan|life span|longevity|healthspan|health span|anti[- ]?aging|extend(ed)? lifespan)\b"),
        ("cancer_apoptosis", r"\b(cancer|apoptosis|cytotoxic|tumor|hepatocellular|breast cancer|cell viability)\b"),
        ("general_longevity", r"\b(ginseng|ginsenoside|panax|triterpenoid|herbal)\b"),
    ),
    "risk": (
        ("faers_adverse", r"\b(faers|adverse event|adverse reaction|reaction_terms)\b"),
        ("cytotoxicity", r"\b(toxicity|toxic|cytotoxicity|cell viability|apoptosis|necrosis|ic50|gi50)\b"),
        ("chemo_combination", r"\b(chemotherapy|radiotherapy|cisplatin|doxorubicin|combined with|co-administration|combination therapy)\b"),
        ("human_safety", r"\b(contraindicat|boxed warning|adverse reaction|tolerability|pregnancy|hepatic impairment)\b"),
        ("cardiac_qt", r"\b(qt|torsade|arrhythmia|cardiac|myocardial)\b"),
        ("liver_kidney", r"\b(hepatotoxic|nephrotoxic|liver|kidney|renal|hepatic)\b"),
        ("interaction_metabolism", r"\b(cyp\d|cytochrome|p-glycoprotein|transporter|warfarin|statin|drug interaction)\b"),
        ("general_risk", r"\b(risk|safety|adverse|toxic)\b"),
    ),
}


# An edge of an ASCII word (\w is ASCII without the flag U), and the letters that any-case search takes for s and k, as in the regular expressions of SQL engines on RE2.
ASCII_EDGE = r"(?:(?<!\w)(?=\w)|(?<=\w)(?!\w))"
ASCII_FOLDS = {"s": "[s\u017f]", "k": "[k\u212a]"}


def matches(text: Column, pattern: str, ascii_words: bool = False) -> Column:
    """Any-case search with Unicode word classes; with ``ascii_words`` any other letter ends a word, so "ci\u00f3nad" holds the word "nad"."""
    if not ascii_words:
        return text.rlike("(?iU)" + pattern)
    folded = re.sub(r"(?<!\\)[sk]", lambda m: ASCII_FOLDS[m[0].lower()], pattern, flags=re.IGNORECASE)
    return text.rlike("(?i)" + _first_letters(pattern) + folded.replace(r"\b", ASCII_EDGE))


def _first_letters(pattern: str) -> str:
    """A look at the next letter, which passes most places by before their edges are tested, if the pattern is a plain list of words."""
    words = re.fullmatch(r"\\b\(([^()\[\]]|\[[^\[\]]*\])*\)\\b", pattern) and re.sub(r"\[[^\[\]]*\]", "", pattern[3:-3]).split("|")
    if not words or not all(re.match("[a-z]", w, re.IGNORECASE) and not re.match(".[?*]", w) for w in words):
        return ""
    first = sorted({w[0].lower() for w in words})
    return "(?=[" + "".join(first) + "".join(ASCII_FOLDS[c][2] for c in first if c in ASCII_FOLDS) + "])"


def _without(value, ignored):
    if isinstance(value, dict):
        return {k: _without(v, ignored) for k, v in value.items() if k not in ignored}
    if isinstance(value, list):
        return [_without(v, ignored) for v in value]
    return value


def plain_json(content_json: Column | str, ignored: Sequence[str] = IGNORED_KEYS) -> Column:
    """The JSON text without the ignored keys at any depth, keys sorted."""
    drop = frozenset(ignored)

    # row by row: a worker holds a hundred texts at once, where an Arrow batch holds thousands and their parsed copies
    @F.udf(StringType(), useArrow=False)
    def strip(value: str | None) -> str:
        return "null" if value is None else json.dumps(_without(json.loads(value), drop), ensure_ascii=False, sort_keys=True)

    return strip(as_col(content_json))


def rule_text(source_type="source_type", content_json="content_json", payload_json: Column | str | None = None, unit_type=None, provenance=None) -> Column:
    """Text the word patterns run over: source, unit type, provenance, content and payload on lines of their own."""
    blank = F.lit("")
    return F.concat_ws(
        "\n", text_of(source_type), text_of(unit_type) if unit_type else blank, text_of(provenance) if provenance else blank,
        plain_json(content_json), plain_json(payload_json) if payload_json is not None else F.lit("null"))


def stem_bits(text: Column, names: Sequence[str], stems: Mapping[str, Sequence[Sequence[str]]] = STEMS) -> Column:
    """A bit for every name whose pattern may match: the text holds the letters that it needs, or letters that an any-case search folds."""
    needs = [tuple(stems.get(k, ())) for k in names]

    # the searches of Python's strings pass over the text many times faster than those of Spark; row by row as in plain_json
    @F.udf(LongType(), useArrow=False)
    def bits(value: str | None) -> int:
        if value is None:
            return 0
        if any(c in value for c in FOLDED):
            return (1 << len(needs)) - 1
        low = value.lower()
        return sum(1 << i for i, groups in enumerate(needs) if all(any(w in low for w in g) for g in groups))

    return bits(text)


def pattern_hits(text: Column, patterns: Mapping[str, str] = PATTERNS, stems: Mapping[str, Sequence[Sequence[str]]] = STEMS, ascii_words: bool = False) -> Column:
    """struct of one boolean per pattern: every pattern runs once per row, and only where the text holds letters it needs."""

    def flags(x: Column) -> Column:
        able, raw = x["able"], x["raw"]
        return F.struct(*[F.when(F.getbit(able, F.lit(i)) == 1, matches(raw, p, ascii_words)).when(raw.isNotNull(), F.lit(False)).alias(k) for i, (k, p) in enumerate(patterns.items())])

    return F.get(F.transform(F.array(F.struct(stem_bits(text, list(patterns), stems).alias("able"), text.alias("raw"))), flags), F.lit(0))


def longevity_override(hit: Mapping[str, Column], source_type, current, flagged: Column | None = None) -> Column:
    """Longevity tag after the word rules. ``flagged`` tells whether a pathway summary has a true flag."""
    source, cur = text_of(source_type), as_col(current)
    weak = cur.isNull() | cur.isin("background_only", "not_relevant")
    raised = case(
        (hit["direct"] & weak, "direct_longevity"),
        (hit["indirect"] & hit["aging_context"] & (weak | (cur == "general_bioactivity")), "indirect_longevity_mechanism"),
        default=cur)
    demote = raised.isin(*LONGEVITY_TAGS) & ~hit["aging_context"] & ((raised == "indirect_longevity_mechanism") | hit["oncology"])
    flagged = F.lit(False) if flagged is None else F.coalesce(flagged, F.lit(False))
    return case(
        ((source == "kegg_summary") & flagged, "indirect_longevity_mechanism"),
        (source.isin(*BACKGROUND_SOURCES), "background_only"),
        ((source == "clinical_trials") & (cur.isNull() | (cur == "not_relevant")), "general_bioactivity"),
        (demote, "general_bioactivity"),
        default=raised)


def _stronger(current: Column, candidate: Column) -> Column:
    rank = lambda c: F.coalesce(lookup(RISK_PRIORITY, c), F.lit(0))
    return F.when(rank(candidate) > rank(current), candidate).otherwise(current)


def risk_override(hit: Mapping[str, Column], source_type, current) -> Column:
    """Risk tag after the source rules, the word rules and the assay demotion; the stronger tag is kept."""
    source, cur = text_of(source_type), as_col(current)
    safety, toxic, interacts = hit["human_safety"], hit["toxicity"], hit["interaction"] | hit["combination"]
    human = F.lit("direct_human_safety")
    base = case((source == "openfda_drug_label", human), ((source == "clinical_trials") & (safety | toxic), human))
    candidate = case(
        (interacts, "interaction_or_combination_risk"),
        (safety, _stronger(base, human)),
        (toxic, _stronger(base, F.lit("toxicity_or_adverse_signal"))),
        default=base)
    merged = _stronger(cur, candidate)
    demote = source.isin(*ASSAY_SOURCES) & merged.isin("toxicity_or_adverse_signal", "pharmacology_risk_theoretical")
    none = cur.isNull() | cur.isin("no_risk_signal", "not_relevant")
    return case(
        (source.isin(*BACKGROUND_SOURCES), F.when(none, F.lit("no_risk_signal")).otherwise(cur)),
        (source == "openfda_faers", "toxicity_or_adverse_signal"),
        (demote, "no_risk_signal"),
        default=merged)


def _searched(text: Column | None, hits, patterns: Mapping[str, str], ascii_words: bool):
    """Whether a pattern is found, by its name: read from the struct ``hits`` where there is one, else searched in the text."""
    return (lambda k: as_col(hits)[k]) if hits is not None else (lambda k: matches(text, patterns[k], ascii_words))


def passes_longevity(text: Column | None = None, tag="longevity_relevance", patterns: Mapping[str, str] = PATTERNS, ascii_words: bool = False, hits=None) -> Column:
    """``hits`` as of ``pattern_hits`` saves the searches."""
    tag, found = as_col(tag), _searched(text, hits, patterns, ascii_words)
    return F.coalesce(F.when(tag == "indirect_longevity_mechanism", found("aging_context")).when(tag == "direct_longevity", found("aging_context") | ~found("oncology")), F.lit(False))


def passes_risk(text: Column | None = None, source_type="source_type", tag="risk_relevance", patterns: Mapping[str, str] = PATTERNS, ascii_words: bool = False, hits=None) -> Column:
    tag, source, found = as_col(tag), text_of(source_type), _searched(text, hits, patterns, ascii_words)
    off_topic = found("oncology") & ~found("aging_context")
    assay = source.isin(*ASSAY_SOURCES)
    strong = found("human_safety") | found("interaction")
    literature = source.isin("clinical_trials", "europe_pmc") | F.startswith(source, F.lit("openalex"))
    toxic = case((assay, F.lit(False)), (source.isin(*LABEL_SOURCES), F.lit(True)), (strong, F.lit(True)), (off_topic, F.lit(False)), default=literature)
    return F.coalesce(case(
        (tag.isin("direct_human_safety", "interaction_or_combination_risk"), F.lit(True)),
        (tag == "pharmacology_risk_theoretical", ~assay & ~off_topic),
        (tag == "toxicity_or_adverse_signal", toxic)), F.lit(False))


def topic_label(text: Column, topics: Sequence[tuple[str, str]], ascii_words: bool = False) -> Column:
    return case(*[(matches(text, p, ascii_words), label) for label, p in topics], default="other")
