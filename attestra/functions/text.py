"""Text columns: citation numbers, DOIs, headings, normal forms, tokens, names, sections, labels."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from attestra.functions.columns import as_col, case, lookup, text_of

LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
#: Gaps between words that are not one blank already, so most words are passed by.
WIDE_GAP = r"(?U) \s+|(?! )\s+"
WORD_GAP = r"(?U)\s+"
SPACES = "".join(chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
ARRAY = "array<string>"


def collapse(text) -> Column:
    """Whitespace runs to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(as_col(text), WIDE_GAP, " "))


def strip_space(text) -> Column:
    """Both ends without any whitespace character."""
    return F.trim(as_col(text), F.lit(SPACES))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for a row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def split_lines(text) -> Column:
    parts = F.split(as_col(text), LINE_BREAK)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


# --- H6 normal forms ------------------------------------------------------------------------------
def strip_front_matter(text) -> Column:
    return F.regexp_replace(as_col(text), r"(?s)\A---\n.*?\n---\n", "")


def normalize(text, mode: str = "lower") -> Column:
    """Collapsed text; "lower" lowers it, "fold" lowers it with the sharp s spelled out as case folding does."""
    flat = collapse(text)
    if mode == "plain":
        return flat
    low = F.lower(flat)
    return F.replace(F.replace(low, F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ")) if mode == "fold" else low


# --- H7 tokens ------------------------------------------------------------------------------------
# Words that say nothing about the topic of a line.
LINE_STOP_WORDS = (
    "the", "and", "for", "with", "from", "into", "this", "that", "these", "those", "are", "was", "were", "will", "have", "has", "had",
    "but", "not", "its", "our", "their", "your", "any", "all", "out", "via", "such", "they", "them", "his", "her", "him", "she", "you",
    "who", "what", "when", "where", "while", "also",
)


def words(text) -> Column:
    return F.filter(F.split(as_col(text), WORD_GAP), lambda w: w != "")


def word_places(words) -> Column:
    """Inverted index of an array of words: word -> its places in ascending order, from 0 on. One sort of the array within its row; null gives null."""
    pairs = F.sort_array(F.transform(as_col(words), lambda w, i: F.struct(w.alias("w"), i.alias("p"))))
    first = lambda s, i: ~F.get(s, i - 1)["w"].eqNullSafe(F.get(s, i)["w"])
    runs = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: first(s, i))
    # an array of one element binds its value once for the expression that reads it many times
    bound = F.transform(F.array(pairs), lambda s: F.struct(s.alias("s"), F.when(F.size(s) > 0, runs(s)).otherwise(F.array().cast("array<int>")).alias("at")))
    entry = lambda x, i, k: F.struct(F.get(x["s"], i)["w"], F.transform(F.slice(x["s"], i + 1, F.coalesce(F.get(x["at"], k + 1), F.size(x["s"])) - i), lambda y: y["p"]))
    return F.when(as_col(words).isNotNull(), F.get(F.transform(bound, lambda x: F.map_from_entries(F.transform(x["at"], lambda i, k: entry(x, i, k)))), F.lit(0)))


def topic_tokens(text) -> Column:
    """Runs of three or more letters or digits, repeats kept."""
    return F.regexp_extract_all(F.lower(as_col(text)), F.lit("([a-z0-9]{3,})"), 1)


def line_tokens(text, stop: Sequence[str] = LINE_STOP_WORDS) -> Column:
    """Distinct words of more than two letters or digits without stop words."""
    parts = F.split(F.regexp_replace(F.lower(text_of(text)), "[^a-z0-9 ]+", " "), " +")
    return F.array_distinct(F.filter(parts, lambda t: (F.length(t) > 2) & ~t.isin(*stop)))


# --- H8 token estimate ----------------------------------------------------------------------------
def estimate_tokens(text) -> Column:
    text = as_col(text)
    return F.greatest(F.floor(F.length(text) / 3.2), F.floor(F.size(words(text)) / 0.75)).cast("int")


# --- H1 citation numbers --------------------------------------------------------------------------
_SPAN = r"^(\d+)\s*[-–—]\s*(\d+)$"


def _numbers(group: Column, max_ref: Column | None) -> Column:
    """Numbers of one comma list; a range counts in either order and never grows past ``max_ref``."""

    def expand(part):
        p = F.trim(part)
        a, b = F.regexp_extract(p, _SPAN, 1).try_cast("int"), F.regexp_extract(p, _SPAN, 2).try_cast("int")
        low, high = F.least(a, b), F.greatest(a, b)
        if max_ref is not None:
            low = F.when(max_ref.isNull(), low).otherwise(F.greatest(low, F.lit(1)))
            high = F.when(max_ref.isNull(), high).otherwise(F.least(high, max_ref))
        span = F.when(p.rlike(_SPAN) & (low <= high), F.sequence(low, high))
        one = F.when(p.rlike(r"^\d+$"), F.array(p.try_cast("int")))
        return F.coalesce(span, one, F.array().cast("array<int>"))

    return F.flatten(F.transform(F.split(group, "[,，]"), expand))


def citation_numbers(text, max_ref: Column | int | None = None, bare: bool = True) -> Column:
    """Sorted distinct reference numbers from numeric-only parentheses and, if asked, bare numeric tails of sentences."""
    text = F.coalesce(as_col(text), F.lit(""))
    bound = None if max_ref is None else (max_ref if isinstance(max_ref, Column) else F.lit(max_ref)).cast("int")
    paren = F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"\(([^)]+)\)"), 1), lambda g: strip_space(g)), lambda g: g.rlike(r"(?U)^[\d\s,，\-–—]+$"))
    groups = paren
    if bare:
        tail = r"(?U)(?<=[a-zà-ž)])\s+(\d+(?:\s*[-–]\s*\d+)?(?:\s*,\s*\d+(?:\s*[-–]\s*\d+)?)*)\s*[.,](?=\s|$)"
        groups = F.concat(paren, F.regexp_extract_all(text, F.lit(tail), 1))
    found = F.flatten(F.transform(groups, lambda g: _numbers(g, bound)))
    if bound is not None:
        found = F.filter(found, lambda n: bound.isNull() | n.between(F.lit(1), bound))
    return F.array_sort(F.array_distinct(F.array_compact(found)))


# --- H2, H3 DOIs ----------------------------------------------------------------------------------
def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.rtrim(F.regexp_extract(text, pattern, 1), F.lit(".,;)")), F.lit(""))


def extract_doi(raw) -> Column:
    """DOI of a reference line: resolver URL, then "doi:", then "doi "."""
    s = F.regexp_replace(as_col(raw), r"(?i)https://doi\.org/https://doi\.org/", "https://doi.org/")
    return F.coalesce(_found(s, r"(?iU)https://doi\.org/(10\.\d+[^\s\]\}<>,;]+)"), _found(s, r"(?iU)doi:\s*(10\.\d+\S+)"), _found(s, r"(?iU)\bdoi\s+(10\.\d+\S+)"))


def page_doi(text) -> Column:
    """First DOI anywhere in a page."""
    return _found(as_col(text), r"(?U)\b(10\.\d{4,9}/\S+)")


def doi_key(doi) -> Column:
    return F.lower(F.regexp_replace(F.trim(as_col(doi)), r"(?i)^https?://(dx\.)?doi\.org/", ""))


def short_doi(doi) -> Column:
    s = F.regexp_replace(F.trim(as_col(doi)), r"(?i)^https?://doi\.org/", "")
    return F.when(F.coalesce(as_col(doi), F.lit("")) == "", "?").when(F.length(s) <= 80, s).otherwise(F.concat(F.substring(s, 1, 77), F.lit("...")))


# --- H4 reference list ----------------------------------------------------------------------------
def reference_index(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Numbered lines after the REFERENCES line, else of the last 40% of lines; the last line of a number wins."""
    header = r"(?i)^\s*\*{0,2}\s*REFERENCES\s*\*{0,2}\s*$"
    lines = docs.select(key, split_lines(text).alias("_lines"))
    at = F.array_position(F.transform("_lines", lambda x: x.rlike(header)), True)
    start = F.when(at > 0, at).otherwise(F.floor(F.size("_lines") * 0.6))
    tail = F.slice("_lines", (start + 1).cast("int"), F.greatest(F.size("_lines") - start, F.lit(0)).cast("int"))
    numbered = lines.select(key, F.posexplode(tail).alias("_pos", "_line")).withColumn("ref_number", F.regexp_extract("_line", r"^\s*(\d+)\.\s+.+$", 1).try_cast("int"))
    last = numbered.filter("ref_number IS NOT NULL").groupBy(key, "ref_number").agg(F.max_by(strip_space("_line"), "_pos").alias("raw_text"))
    return last.withColumn("doi", extract_doi("raw_text"))


# --- H5 headings ----------------------------------------------------------------------------------
def split_headings(text) -> Column:
    """array<struct<heading, body>> of a markdown text: preface "Header", then its headings; without any, one "Body"."""
    text = as_col(text)
    head = r"(?s)\A#{1,6}\s+([^\n]+)(.*)\z"
    pieces = F.split(text, r"(?m)(?=^#{1,6}\s+\S)")

    def section(p):
        headed = p.rlike(head)
        return F.struct(F.when(headed, F.trim(F.regexp_extract(p, head, 1))).otherwise("Header").alias("heading"),
                        F.when(headed, strip_space(F.regexp_extract(p, head, 2))).otherwise(strip_space(p)).alias("body"))

    sections = F.filter(F.transform(pieces, section), lambda s: (s["heading"] != "Header") | (s["body"] != ""))
    whole = F.array(F.struct(F.lit("Body").alias("heading"), text.alias("body")))
    return F.when(text.rlike(r"(?m)^#{1,6}\s+\S"), sections).otherwise(whole)


# --- H12 safe names -------------------------------------------------------------------------------
RESERVED_NAMES = ("CON", "PRN", "AUX", "NUL") + tuple(f"{p}{i}" for p in ("COM", "LPT") for i in range(1, 10))
MIME_EXTENSIONS = {
    "application/pdf": "pdf", "application/x-pdf": "pdf", "video/mp4": "mp4", "video/quicktime": "mov", "image/png": "png",
    "image/jpeg": "jpg", "image/gif": "gif", "image/webp": "webp",
}
_RESERVED_CHARS = r'[<>:"/\\|?*\x00-\x1f]'


def safe_stem(name) -> Column:
    s = F.trim(F.regexp_replace(as_col(name), _RESERVED_CHARS, "_"), F.lit(" ._-"))
    s = F.substring(F.when(s == "", "document").otherwise(s), 1, 120)
    return F.when(F.upper(s).isin(*RESERVED_NAMES), F.concat(F.lit("_"), s, F.lit("_"))).otherwise(s)


def safe_id(name) -> Column:
    s = F.substring(F.trim(F.regexp_replace(as_col(name), "[^A-Za-z0-9_-]+", "_"), F.lit("_")), 1, 60)
    return F.when(s == "", "x").otherwise(s)


def safe_file(name, max_len: int = 120) -> Column:
    s = F.trim(F.regexp_replace(F.regexp_replace(F.trim(as_col(name)), _RESERVED_CHARS, "_"), "_+", "_"), F.lit("._ "))
    return F.when(s == "", "unnamed").otherwise(F.substring(s, 1, max_len))


def folder_name(name) -> Column:
    s = F.trim(F.regexp_replace(F.regexp_replace(as_col(name), _RESERVED_CHARS, "_"), WORD_GAP, " "))
    s = F.regexp_replace(F.regexp_replace(F.rtrim(s, F.lit(". ")), "_+", "_"), r"^\.+", "")
    s = F.substring(s, 1, 120)
    return F.when(s == "", "unnamed").otherwise(s)


def file_name(path, content_type) -> Column:
    """Path with slashes as underscores, an extension from the MIME type added when it has none."""
    name = F.replace(F.regexp_replace(as_col(path), "^/+", ""), F.lit("/"), F.lit("_"))
    base = F.lower(F.trim(F.substring_index(text_of(content_type), ";", 1)))
    sub = F.regexp_replace(F.regexp_extract(base, "^[^/]*/(.*)$", 1), "^x-", "")
    ext = F.coalesce(lookup(MIME_EXTENSIONS, base), F.when(sub.rlike("^[a-z0-9.+-]+$"), sub))
    return F.when(name.rlike(r"\.[a-zA-Z0-9]{1,10}$") | ext.isNull(), name).otherwise(F.concat(name, F.lit("."), ext))


# --- H17 document sections ------------------------------------------------------------------------
def section_text(kind: str, text) -> Column:
    text = as_col(text)
    if kind == "abstract":
        body = collapse(F.regexp_extract(text, r"(?is)(?:\A|\n)\s*(?:#{1,3}\s*)?(?:abstract|summary)\s*\n(.*?)(?=\n#{1,3}\s|\n\s*(?:background|introduction|methods|objectives)\s*\n|\z)", 1))
        return once(body, lambda b: F.when(F.length(b) > 100, b).otherwise(strip_space(F.substring(text, 1, 3000))))
    if kind == "budget":
        patterns = (
            r"(?is)(?:\A|\n)\s*(?:#{1,3}\s*)?(?:budget|funding|cost)\s*(?:outline|breakdown|summary|estimate)?\s*\n(.*?)(?=\n#{1,3}\s|\z)",
            r"(?is)(?:budget|estimated.*?budget|overall.*?budget).*?\n(.*?)(?=\n#{1,3}\s|\n\s*(?:open.?science|references|limitations|timeline|milestones)\s*\n|\z)",
        )
        found = [strip_space(F.regexp_extract(text, p, 1)) for p in patterns]
        return F.coalesce(*[once(f, lambda x: F.when(F.length(x) > 50, F.substring(x, 1, 3000))) for f in found], F.lit(""))
    if kind == "keywords":
        marked = F.filter(F.split(text, LINE_BREAK), lambda x: x.rlike(r"(?i)^\*?Keywords\*?[:\s]+.+"))
        listed = F.regexp_extract(F.try_element_at(marked, F.lit(-1)), r"(?i)^\*?Keywords\*?[:\s]+(.+)", 1)
        return F.filter(F.transform(F.split(listed, "[,;]"), lambda k: F.trim(k)), lambda k: k != "")
    if kind == "published":
        return F.nullif(F.rtrim(F.trim(F.regexp_extract(text, r"(?i)\*{0,2}Published[:\s]*\*{0,2}\s*(.+)", 1)), F.lit("*")), F.lit(""))
    if kind == "captions":
        found = F.transform(F.regexp_extract_all(text, F.lit(r"(?s)<img>([^<]*)</img>"), 1), lambda c: strip_space(c))
        return F.filter(found, lambda c: (F.length(c) >= 20) & ~c.rlike(r"(?i)^(researchhub\s+journal\s*(logo)?|journal\s+logo|logo)$"))
    raise ValueError(f"unknown section kind {kind}")


# --- H18 names ------------------------------------------------------------------------------------
@F.udf(StringType(), useArrow=False)
def _nfkc(value: str | None) -> str | None:
    return value if value is None or value.isascii() else unicodedata.normalize("NFKC", value)


def norm_name(name) -> Column:
    """NFKC (no JVM built-in, so a row at a time in Python, where batches of whole texts would fill a worker), whitespace collapsed, lower case."""
    return F.lower(collapse(_nfkc(text_of(name))))


def parse_names(text) -> Column:
    """Names of "Compound 1: x; Compound 2: y"; any other text is one name."""
    t = F.trim(text_of(text))
    parts = F.filter(F.transform(F.split(t, ";"), lambda p: F.trim(p)), lambda p: p != "")
    numbered = F.transform(parts, lambda p: F.trim(F.regexp_replace(p, r"(?i)^compound\s+\d+:\s*(?=\S)", "")))
    listed = F.trim(F.substring_index(t, ";", 1)).rlike(r"(?i)^compound\s+\d+:\s*.+$")
    return F.when(t == "", F.array().cast(ARRAY)).when(listed, numbered).otherwise(F.array(t))


def subject_line(names) -> Column:
    names = as_col(names)
    n = F.size(names)
    last = F.element_at(names, -1)
    many = F.concat(F.array_join(F.slice(names, F.lit(1), F.greatest(n - 1, F.lit(0))), ", "), F.lit(", and "), last)
    body = case((n == 0, "(unknown)"), (n == 1, last), (n == 2, F.array_join(names, " and ")), default=many)
    return F.concat(F.lit("Compound(s): "), body, F.lit("."))


# --- H19 display forms ----------------------------------------------------------------------------
def truncate(text, size: int) -> Column:
    s = F.trim(F.replace(as_col(text), F.lit("\n"), F.lit(" ")))
    return F.when(F.length(s) <= size, s).otherwise(F.concat(F.substring(s, 1, size - 1), F.lit("…")))


def review_date(ts) -> Column:
    return F.date_format(as_col(ts), "MMMM d, yyyy")


def token_amount(raw, decimals) -> Column:
    """Integer amount scaled by its decimals."""
    d = F.coalesce(as_col(decimals).try_cast("int"), F.lit(0))
    return as_col(raw).try_cast("decimal(38,0)").cast("double") / F.pow(F.lit(10.0), d)


# --- H21 sources and marks ------------------------------------------------------------------------
# Ranks and marks of verdicts and severities.
VERDICT_MARKS = {"valid": "✅", "positive": "✅", "invalid": "❌", "negative": "❌", "inconclusive": "❓", "neutral": "·"}
SEVERITY_RANK = {"red_flag": 0, "concern": 1, "info": 2}


def source_key(kind="source_kind", domain="domain", title="doc_title") -> Column:
    k, d, t = text_of(kind), text_of(domain), text_of(title)
    prefix = case((k == "pdf", "pdf"), (k == "image_caption", "image"), (k.isin("video_transcript", "video_frame"), "video"), (k == "text_doc", "text"), default=k)
    return case((k == "onchain_fact", "onchain"), ((k == "crawl_md") & (d != ""), F.concat(F.lit("crawl::"), d)), default=F.concat(prefix, F.lit("::"), t))


def public_label(kind="source_kind", domain="domain", title="doc_title") -> Column:
    k, d, t = text_of(kind), F.trim(text_of(domain)), F.trim(text_of(title))
    named = lambda head, other: F.concat(F.lit(head), F.when(t != "", t).otherwise(other))
    return case(
        ((k == "crawl_md") & (d != ""), d), (k == "onchain_fact", "IPNFT on-chain profile"), (k == "pdf", named("Dataroom PDF · ", "PDF")),
        (k == "image_caption", named("Dataroom image · ", "image")), (k.isin("video_transcript", "video_frame"), named("Dataroom video · ", "video")),
        (k == "text_doc", named("Dataroom file · ", "")), (d != "", d),
        default=F.coalesce(F.nullif(t, F.lit("")), F.nullif(k, F.lit("")), F.lit("source")))


def public_url(kind="source_kind", domain="domain", item_id: Column | str = "item_id", page: str = "https://mint.molecule.to/") -> Column:
    k, d = text_of(kind), F.trim(text_of(domain))
    known = k.isin("onchain_fact", "pdf", "image_caption", "video_transcript", "video_frame", "text_doc")
    own = F.coalesce(F.concat(F.lit(page + "ipnft/"), F.nullif(as_col(item_id).cast("string"), F.lit(""))), F.lit(page))
    return F.when((d != "") & ~known, F.concat(F.lit("https://"), d, F.lit("/"))).otherwise(own)


def verdict_mark(verdict) -> Column:
    return F.coalesce(lookup(VERDICT_MARKS, as_col(verdict)), F.lit("·"))


def severity_rank(severity) -> Column:
    return F.coalesce(lookup(SEVERITY_RANK, as_col(severity)), F.lit(2))


# --- D7 repeated sentences ------------------------------------------------------------------------
def dedupe_sentences(text) -> Column:
    """Sentences in order, a repeat in any case left out. Sorting brings repeats together, so a text takes n log n steps."""
    parts = F.filter(F.transform(F.split(as_col(text), r"(?U)(?<=[.!?])\s+"), lambda s: strip_space(s)), lambda s: s != "")
    sorted_parts = F.array_sort(F.transform(parts, lambda s, i: F.struct(F.lower(s).alias("low"), i.alias("i"), s.alias("s"))))
    first = lambda e: F.filter(e, lambda x, k: ~F.get(e, k - 1)["low"].eqNullSafe(x["low"]))
    kept = F.get(F.transform(F.array(sorted_parts), first), F.lit(0))  # the sorted parts are a lambda's own variable: computed once
    return F.array_join(F.transform(F.array_sort(F.transform(kept, lambda x: F.struct(x["i"], x["s"]))), lambda x: x["s"]), " ")


# --- H25 fingerprints -----------------------------------------------------------------------------
def fingerprint(text, short: bool = False) -> Column:
    digest = F.sha2(as_col(text), 256)
    return F.substring(digest, 1, 16) if short else digest


# --- H24 allow-listed tokens ----------------------------------------------------------------------
def _clean_token(t: Column) -> Column:
    tail = F.regexp_replace(F.trim(t), r"""(?<=.)[.,;:!?'")\]}\s]+$""", "")
    return F.regexp_replace(tail, r"""^[.,;: '"({\[]+(?=.)""", "")


def allowed_tokens(answer, allow: Sequence[str], aliases: Mapping[str, str] | None = None) -> Column:
    """Tokens of an answer that are on the list, in order, punctuation trimmed and aliases mapped."""
    plain = F.regexp_replace(text_of(answer), r"```(?:\w*)?", "")
    tokens = F.transform(words(plain), _clean_token)
    if aliases:
        tokens = F.transform(tokens, lambda t: F.coalesce(lookup(aliases, t), t))
    return F.filter(tokens, lambda t: t.isin(*allow))


def parse_tag(answer, allow: Sequence[str], aliases: Mapping[str, str] | None = None) -> Column:
    """First allowed token: of the last non-blank line, else of the whole answer."""
    filled = F.filter(split_lines(text_of(answer)), lambda x: F.trim(x) != "")
    last = F.try_element_at(filled, F.lit(-1))
    return F.coalesce(F.try_element_at(allowed_tokens(last, allow, aliases), F.lit(1)), F.try_element_at(allowed_tokens(answer, allow, aliases), F.lit(1)))


def first_tags(answer, allow: Sequence[str], k: int = 3) -> Column:
    """Up to k distinct allowed tags of an answer, first seen first."""
    plain = F.regexp_replace(text_of(answer), r"```(?:\w*)?", "")
    return F.slice(F.array_distinct(F.filter(words(plain), lambda t: t.isin(*allow))), 1, k)


def classification_columns(tags) -> dict[str, Column]:
    """Three arrays of at most one tag each."""
    return {f"claim_classification_{i}": F.slice(as_col(tags), i, 1) for i in (1, 2, 3)}


def end_sentence(text) -> Column:
    """Text up to its last full sentence; the whole text when it has none."""
    t = strip_space(text)
    cut = F.regexp_extract(t, r"(?s)\A(.*[.!?])", 1)
    return F.when(cut == "", t).otherwise(cut)


def known_citations(cited, retrieved) -> Column:
    """Distinct cited ids that were retrieved, first seen first."""
    retrieved = as_col(retrieved)
    return F.filter(F.array_distinct(as_col(cited)), lambda c: F.array_contains(retrieved, c))


