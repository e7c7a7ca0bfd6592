"""Citations, chunks and context windows of claims."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.functions.columns import as_col, contains_any, text_of
from attestra.functions.text import citation_numbers, doi_key, normalize, strip_space
from attestra.operators.joins import maybe_met
from attestra.operators.ranking import concat_budget, first_rows, running
from attestra.session import cut_lineage

# Heading hints per claim type for the second context layer, those of any other type, and what stands where there is no text.
CONTEXT_HINTS = {
    "Fact": ("result", "finding", "data", "efficacy"),
    "Assertion": ("result", "discussion", "conclusion"),
    "Roadmap": ("discussion", "conclusion"),
}
OTHER_HINTS = ("method", "result", "conclusion")
NO_CONTEXT = "No key sections available for this document."


def attach_chunk(claims: DataFrame, chunks: DataFrame, on: Sequence[str]) -> DataFrame:
    return claims.join(chunks, list(on), "left")


def missing_chunks(claims: DataFrame, chunks: DataFrame, on: Sequence[str]) -> DataFrame:
    """Claims whose chunk is absent."""
    return claims.join(chunks.select(*on), list(on), "left_anti")


def last_chunk(chunks: DataFrame, on: Sequence[str], pos: str) -> DataFrame:
    """One row per chunk id; the last one read wins."""
    rest = [c for c in chunks.columns if c not in on]
    return chunks.groupBy(*on).agg(F.max_by(F.struct(*rest), pos).alias("_c")).select(*on, *[F.col(f"_c.{c}").alias(c) for c in rest])


def citation_rows(cited: DataFrame, refs: DataFrame, works: DataFrame, by: Sequence[str], doc: str, numbers: str = "numbers", cut: int = 500) -> DataFrame:
    """Long citation table: number -> reference -> normalised DOI -> work; what does not resolve stays null."""
    long = cited.select(*by, doc, F.explode(numbers).alias("ref_number"))
    r = refs.select(doc, "ref_number", "doi", doi_key("doi").alias("_key"))
    w = works.withColumn("_key", doi_key("doi")).drop("doi")
    joined = long.join(r, [doc, "ref_number"], "left").join(w, "_key", "left").drop("_key")
    return joined.withColumn("abstract", F.substring("abstract", 1, cut))


def usable_refs(citations: DataFrame) -> DataFrame:
    """Citations whose work was found and has an abstract."""
    return citations.filter((F.col("status") == "ok") & (F.coalesce("abstract", F.lit("")) != ""))


def window_refs(windows: DataFrame, refs: DataFrame, works: DataFrame, by: Sequence[str], doc: str, k: int = 3, snippet: int = 200) -> DataFrame:
    """Per text window the first k cited works with an abstract, as snippets."""
    rows = usable_refs(citation_rows(windows, refs, works, by, doc, cut=snippet))
    return first_rows(rows, by, ["ref_number"], k, "rank")


_SEED = 12


def _seeds(text: Column) -> Column:
    """Twelve characters from every word start but the first: a text that holds the claim holds the claim's seeds."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?<= )(?=(.{{{_SEED}}}))"), 1)


def borrow_citations(claims: DataFrame, chunks: DataFrame, doc: str = "doc_name", claim: str = "claim", text: str = "text", claim_id: str = "claim_id", chunk_id: str = "chunk_id",
                     max_ref: int | None = None, min_len: int = 30, prefix: int = 200, bare: bool = True) -> DataFrame:
    """Citation numbers of other chunks of the document that hold the claim or its first 200 characters.

    Only claims whose own chunk cites nothing and chunks that cite something take part. Both sides shrink to distinct texts,
    meet on one seed per claim instead of on all pairs of a document, and are then checked for containment.
    """
    numbered = chunks.select(doc, chunk_id, text).withColumn("_nums", citation_numbers(text, max_ref, bare))
    whole = normalize(claim, "fold")
    asked = claims.filter(F.length(F.trim(F.col(claim))) >= min_len).select(claim_id, doc, chunk_id, F.when(F.length(whole) >= 20, F.substring(whole, 1, prefix)).otherwise(whole).alias("_needle"))
    home = asked.join(numbered.select(doc, chunk_id, F.size("_nums").alias("_own")), [doc, chunk_id], "left")
    needle = cut_lineage(home.filter(F.coalesce("_own", F.lit(0)) == 0).select(claim_id, doc, "_needle"))  # read four times, cut from whole claims once
    met_at = lambda seed: F.xxhash64(F.col(doc), seed)
    # the seed of least hash: any one, where the least in letters would be one of common words
    distinct = needle.select(doc, "_needle").distinct().withColumn("_at", F.array_min(F.transform(_seeds(F.col("_needle")), met_at)))
    texts = numbered.filter(F.size("_nums") > 0).select(doc, normalize(text, "fold").alias("_text"), "_nums").withColumn("_tid", F.xxhash64(doc, "_text"))
    # Exploded rows are two hashes each, and those that no claim's seed can meet go before they move; of the texts only those of a candidate move, once,
    # and shrink to distinct ones then. Merge joins, since the exploded size is not bounded.
    together = lambda df: df.groupBy(doc, "_tid").agg(F.first("_text").alias("_text"), F.array_distinct(F.flatten(F.collect_list("_nums"))).alias("_ns"))
    seeded = texts.select("_tid", F.explode(F.array_distinct(F.transform(_seeds(F.col("_text")), met_at))).alias("_at"))
    seeking = distinct.filter("_at IS NOT NULL").select("_at", doc, "_needle")
    candidates = cut_lineage(maybe_met(seeded, seeking, "_at").distinct().hint("merge").join(seeking, "_at").drop("_at"))
    met = together(maybe_met(texts, candidates, "_tid")).hint("merge").join(candidates, [doc, "_tid"]).filter(F.contains("_text", F.col("_needle")))
    # one long word: rare, met on the document alone by the texts with a word as long
    bare_needles = cut_lineage(distinct.filter("_at IS NULL").select(doc, "_needle"))
    longest = lambda c: F.array_max(F.transform(F.split(c, " "), lambda w: F.length(w)))
    least = bare_needles.agg(F.min(longest(F.col("_needle"))).alias("_least"))
    wordy = maybe_met(texts.withColumn("_at", F.xxhash64(doc)), bare_needles.select(F.xxhash64(doc).alias("_at")), "_at").drop("_at")
    wordy = wordy.crossJoin(F.broadcast(least)).filter(longest(F.col("_text")) >= F.col("_least"))
    few = together(wordy).hint("merge").join(bare_needles, doc).filter(F.contains("_text", F.col("_needle")))
    hits = met.select(doc, "_needle", "_ns").unionByName(few.select(doc, "_needle", "_ns"))
    lent = hits.select(doc, "_needle", F.explode("_ns").alias("_n")).groupBy(doc, "_needle").agg(F.array_sort(F.collect_set("_n")).alias("numbers"))
    return needle.select(claim_id, doc, "_needle").join(lent, [doc, "_needle"]).select(claim_id, "numbers")


def context_window(claims: DataFrame, chunks: DataFrame, doc: str = "doc_name", source: str = "chunk_id", k: int = 1, claim_id: str = "claim_id") -> DataFrame:
    """Chunks within k of the claim's own, met on the exploded ids."""
    near = claims.select(claim_id, doc, F.explode(F.sequence(F.col(source) - k, F.col(source) + k)).alias("_near"))
    return near.join(chunks.withColumnRenamed("chunk_id", "_near"), [doc, "_near"]).withColumnRenamed("_near", "chunk_id")


def _cut_parts(parts: DataFrame, budget: int) -> DataFrame:
    """Parts in chunk order while the characters before them are below the budget; the last is cut to what is left. Joined by blank lines."""
    w = Window.partitionBy("_claim").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("_piece")).over(w), F.lit(0))
    kept = parts.withColumn("_before", before).filter(F.col("_before") < budget).withColumn("_piece", F.substring("_piece", F.lit(1), (F.lit(budget) - F.col("_before")).cast("int")))
    return kept.groupBy("_claim").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_chunk", "_piece"))), lambda x: x["_piece"]), "\n\n").alias("_text"))


def context_sections(claims: DataFrame, chunks: DataFrame, k: int = 1, budget: int = 6000, hints: Mapping[str, Sequence[str]] = CONTEXT_HINTS, other: Sequence[str] = OTHER_HINTS,
                     doc: str = "doc_name", source: str = "chunk_id", heading: str = "section_heading", text: str = "text", claim_id: str = "claim_id", claim_type: str = "claim_type") -> DataFrame:
    """Context of every claim, one row each: its own chunk and k neighbours in half of the budget, then other chunks whose heading hints at the claim's type in the rest.

    Types without hints of their own take ``other``. The budget bounds the rows per document and type before claims meet them, so a claim
    meets a short list and never all chunks: a near chunk takes at most one budget off the sum, so rows past 2k+2 budgets are out of reach.
    """
    half = budget // 2
    rest = budget - half
    part = F.concat(F.lit("["), F.coalesce(F.col(heading), F.lit("Unknown")), F.lit("]\n"), F.coalesce(F.col(text), F.lit("")))
    kind = F.when(F.col(claim_type).isin(*hints), F.col(claim_type)).otherwise(F.lit(""))
    own = claims.select(F.col(claim_id).alias("_claim"), F.col(doc).alias("_doc"), F.col(source).alias("_src"), kind.alias("_type"))
    parts = chunks.select(F.col(doc).alias("_doc"), F.col("chunk_id").alias("_chunk"), F.lower(F.coalesce(F.col(heading), F.lit(""))).alias("_head"), part.alias("_piece"))
    near = own.select("_claim", "_doc", F.explode(F.sequence(F.col("_src") - k, F.col("_src") + k)).alias("_chunk")).join(
        parts.select("_doc", "_chunk", F.substring("_piece", 1, half).alias("_piece")), ["_doc", "_chunk"])  # no part shows more than its budget, so no more moves
    tests = {t: contains_any(F.col("_head"), words) for t, words in {**hints, "": other}.items()}
    typed = parts.withColumn("_type", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(t)) for t, c in tests.items()]))))
    short = first_rows(typed, ["_doc", "_type"], ["_chunk"], rest // 3 + 2 * k + 2).select("_doc", "_type", "_chunk", F.substring("_piece", 1, rest).alias("_piece"))  # a part has three characters at least
    size = F.least(F.length("_piece"), F.lit(rest)).cast("long")
    reach = running(short, ["_doc", "_type"], "_chunk", size, "_sum").filter(F.col("_sum") - size < rest * (2 * k + 2))
    far = own.join(reach, ["_doc", "_type"]).filter(F.abs(F.col("_chunk") - F.col("_src")) > k).select("_claim", "_chunk", "_piece")
    a, b = _cut_parts(near.select("_claim", "_chunk", "_piece"), half).withColumnRenamed("_text", "_a"), _cut_parts(far, rest).withColumnRenamed("_text", "_b")
    joined = own.select("_claim").join(a, "_claim", "left").join(b, "_claim", "left")
    whole = strip_space(F.concat_ws("\n\n", F.nullif("_a", F.lit("")), F.nullif("_b", F.lit(""))))
    return joined.select(F.col("_claim").alias(claim_id), F.when(whole == "", NO_CONTEXT).otherwise(whole).alias("context"))


def rebuild_abstract(inverted) -> Column:
    """Words of an inverted index (word -> positions) in position order."""
    slots = F.flatten(F.transform(F.map_entries(as_col(inverted)), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    some = F.exists(F.map_values(as_col(inverted)), lambda p: F.size(p) > 0)
    return F.when(some, F.array_join(F.transform(F.array_sort(slots), lambda s: s["w"]), " "))


def outline(chunks: DataFrame, by: Sequence[str], heading: str, pos: str, text: str) -> DataFrame:
    """Distinct headings in first-seen order with their chunk count and joined bodies."""
    h = chunks.withColumn("heading", F.trim(F.col(heading))).filter("heading <> ''")
    body = F.when(F.trim(F.col(text)) != "", F.trim(F.col(text)))
    agg = h.groupBy(*by, "heading").agg(F.min(pos).alias("first_pos"), F.count("*").alias("chunks"), F.array_sort(F.collect_list(F.struct(F.col(pos), body.alias("b")))).alias("_b"))
    return agg.withColumn("body", F.array_join(F.filter(F.transform("_b", lambda s: s["b"]), lambda b: b.isNotNull()), "\n\n")).drop("_b")


def doc_title(chunks: DataFrame, doc: str, pos: str, heading: str) -> DataFrame:
    """Longest heading of the first five chunks, those over 20 characters first; the earlier one wins a tie."""
    five = first_rows(chunks, [doc], [pos], 5, "_rank")
    return five.groupBy(doc).agg(F.nullif(F.max_by(F.col(heading), F.struct(F.length(heading), -F.col("_rank"))), F.lit("")).alias("title"))


def doc_abstract(chunks: DataFrame, doc: str, pos: str, text: str, category: str, heading: str, mode: str = "first", prefix: int = 3000) -> DataFrame:
    """"first": the first abstract chunk; "headed": all chunks under an abstract heading; else the document's first characters."""
    t = F.trim(F.col(text))
    if mode == "first":
        return first_rows(chunks.filter(F.col(category) == "abstract"), [doc], [pos]).select(doc, F.nullif(t, F.lit("")).alias("abstract"))
    picked = chunks.filter(F.contains(F.lower(heading), F.lit("abstract"))) if mode == "headed" else chunks
    return concat_budget(picked, [doc], [pos], t, prefix, " ", "abstract").select(doc, "abstract")


def extractable_chunks(chunks: DataFrame, heading: str = "section_heading", text: str = "text", hints: str = "hints", min_len: int = 80) -> DataFrame:
    """Chunks worth extracting from: no reference sections, and hints or enough text."""
    refs = F.lower(F.trim(text_of(heading))).rlike("^(references|bibliography|works cited|literature cited)")
    return chunks.filter(~refs & ((F.size(hints) > 0) | (F.length(F.trim(text_of(text))) >= min_len)))


