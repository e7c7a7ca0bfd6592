"""Whole project audits: header, counts, category table, every source with its lines, literature and missing facts.

A document is a table of blocks with an order. Counts are taken per source with map-side partials and projects are summed from these; lines are
ranked within a source and cut to the listed ones before any text moves. Only then blocks meet their project.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra import config as C
from attestra.functions.columns import lit_array, text_of
from attestra.functions.text import public_label, public_url, source_key, strip_space, verdict_mark

# The verdicts that are listed, in order; kinds of sources in order; names that hide a person; texts of the document.
LISTED = ("valid", "positive", "negative", "invalid", "inconclusive")
SOURCE_ORDER = ("crawl::", "onchain", "pdf::", "video::", "image::")
HIDDEN_NAMES = ("", "anon", "anonymous", "pseudonym", "n/a")
CATEGORY_TABLE = ("| Category | Score | Weighted favorable / scored | Raw favorable / scored | Lines | Clusters |",
                  "|----------|-------|-----------------------------|------------------------|-------|----------|")
WORK_TABLE = ("| Paper | Year | Cited by | Used for lines |", "|-------|------|----------|----------------|")
NO_VERDICTS = "*No meaningful verdicts produced from this source.*"
NO_CITATIONS = "*No OpenAlex citations were anchored during validation.*"
NO_GAPS = "*No structural gaps detected.*"
GAPS = {
    "agreements": "No on-chain legal agreements present.",
    "development": "On-chain Assignment Agreement is present, but no Development Agreement was found.",
    "token": "No IPT (IP Token) issued for this IPNFT.",
    "markets": "IPT exists but no markets are registered.",
    "lead": "Research lead is anonymous or pseudonymous on-chain.",
    "pdf": "No PDF text was processed — the dataroom had no PDFs or vision was skipped.",
    "crawl": "No crawled web pages were ingested.",
    "video": "No video audio was transcribed (whisper.cpp may not be set up, or the dataroom had no videos).",
}
#: Explanations under the headings; a caller may give others.
INTRO = ("A public trail of the review: every link leads to a source anyone can open, with the lines taken from it, their scores, and the papers that scientific claims were held against.",)
SCORING = ("**How scores come about.** A line is judged by the rules of its own category only; it weighs as much as its source kind and line type say; lines that repeat one idea share a cluster, "
           "and each of them counts its weight divided by the square root of the cluster's size.", "",
           "The score is the favorable share of the effective weight of all favorable and unfavorable lines, in percent. Neutral and inconclusive lines do not count.")
SOURCES = ("Every source that was read, with the lines taken from it.",)
LITERATURE = ("Papers that were retrieved and cited while scientific claims were validated.",)
TITLE_CHARS = 160


def _lines(*parts) -> Column:
    """Lines joined; a null part is left out."""
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _text(*parts) -> Column:
    """Parts run together, null parts as nothing."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def _or(c, default: str) -> Column:
    return F.coalesce(F.nullif(text_of(c), F.lit("")), F.lit(default))


def _two_places(c) -> Column:
    """Two decimals of the number's exact value, halves to the even digit."""
    return F.call_function("format_number", F.coalesce(c, F.lit(0.0)).cast("double"), F.lit("0.00"))


def _padded(c: str) -> Column:
    """Numbers as text that sorts as they do, negative ones too."""
    return F.lpad((F.coalesce(F.col(c), F.lit(0)).cast("decimal(20,0)") + F.lit(1 << 62).cast("decimal(20,0)")).cast("string"), 20, "0")


def _verdict() -> Column:
    return _or("verdict", "neutral")


def _place() -> Column:
    """Place of a verdict among the listed ones, from 1; 0 for others."""
    return F.array_position(lit_array(LISTED), _verdict())


def sources(key: str, chunks: DataFrame, lines: DataFrame) -> DataFrame:
    """key, source, chunks, sample (kind, domain and title of the first chunk), kinds (pdf, crawl, video), n (lines), verdicts (name=count), listed,
    favorable, unfavorable, open: a row for every source that has chunks or lines; sample is null without chunks.

    Repeated rows count as often as they stand; null verdicts are neutral; no rows give no rows.
    """
    kind = lambda k: F.max(F.coalesce(F.col("source_kind") == k, F.lit(False)))
    read = chunks.withColumn("source", source_key()).groupBy(F.col(key).alias("key"), "source").agg(
        F.count("*").alias("chunks"), F.min_by(F.struct("source_kind", "domain", "doc_title"), "chunk_id").alias("sample"),
        F.struct(kind("pdf").alias("pdf"), kind("crawl_md").alias("crawl"), kind("video_transcript").alias("video")).alias("kinds"))
    counted = lines.select(F.col(key).alias("key"), source_key().alias("source"), _verdict().alias("v")).groupBy("key", "source", "v").agg(F.count("*").alias("m"))
    of = lambda names, name: F.sum(F.when(F.col("v").isin(*names), F.col("m")).otherwise(0)).alias(name)
    named = F.array_sort(F.collect_list(F.struct("v", "m")))  # names of verdicts, not lines
    judged = counted.groupBy("key", "source").agg(
        F.sum("m").alias("n"), F.array_join(F.transform(named, lambda x: F.concat(x["v"], F.lit("="), x["m"].cast("string"))), ", ").alias("verdicts"),
        of(LISTED, "listed"), of(C.FAVORABLE_VERDICTS, "favorable"), of(C.UNFAVORABLE_VERDICTS, "unfavorable"), of(("inconclusive",), "open"))
    return read.join(judged, ["key", "source"], "full_outer")


def source_blocks(key: str, found: DataFrame, lines: DataFrame, per_source: int, page: str) -> DataFrame:
    """Blocks of the source section: a head for every source, its first lines, and what closes it."""
    rank = F.coalesce(*[F.when(F.startswith("source", F.lit(p)), F.lit(i)) for i, p in enumerate(SOURCE_ORDER)], F.lit(len(SOURCE_ORDER)))
    ord_of = lambda part, place: F.array(rank.cast("string"), F.col("source"), F.lit(part), place)
    shown = found.filter("sample is not null")
    zero = lambda c: F.coalesce(c, F.lit(0))
    sample = shown.select("*", "sample.*")
    label, url = public_label(), public_url(page=page)
    none = zero("listed") == 0
    head = _lines(_text("### ", label), "", _text("**Link:** [", url, "](", url, ")  "),
                  _text("**Chunks read:** ", F.col("chunks"), " · **Lines extracted:** ", zero("n"), " · **Verdicts:** ", _or("verdicts", "—")), "",
                  F.when(none, _lines(NO_VERDICTS, "")))
    rest = zero("listed") - per_source
    foot = F.when(~none, _lines(F.when(rest > 0, _text("- _… ", rest, " additional scored line(s) omitted._")), ""))
    heads = sample.select("key", F.explode(F.array(F.struct(ord_of("0", F.lit("")).alias("ord"), head.alias("block")), F.struct(ord_of("2", F.lit("")).alias("ord"), foot.alias("block")))).alias("x")).select("key", "x.*")
    ranked = lines.withColumn("key", F.col(key)).withColumn("source", source_key()).withColumn("_place", _place()).filter(F.col("_place") > 0)
    first = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy("key", "source").orderBy("_place", "seq", "line_id"))).filter(F.col("_rank") <= per_source)
    first = first.join(shown.select("key", "source"), ["key", "source"], "left_semi")
    said, quote, why = strip_space(text_of("text")), strip_space(text_of("verbatim_quote")), strip_space(text_of("rationale"))
    effective = F.coalesce("effective_weight", "weight")
    cluster = F.when(F.col("cluster_size") > 1, _text(" · cluster ×", F.col("cluster_size")))
    cited = F.when(F.size("citations") > 0, _text("    Supporting literature: ", F.array_join(F.transform("citations", lambda w: F.concat(F.lit("["), w, F.lit("](https://openalex.org/"), w, F.lit(")"))), ", ")))
    block = _lines(
        _text("- ", verdict_mark("verdict"), " **", F.col("verdict"), "** · `#", _or(F.col("line_id").cast("string"), "?"), "` · _", F.replace(text_of("category"), F.lit("_"), F.lit(" ")), " · ", _or("line_type", "?"),
              " · weight ", _two_places(F.col("weight")), " → eff ", _two_places(effective), cluster, "_ — ", said),
        F.when((quote != "") & (F.lower(quote) != F.lower(said)), _text("    > ", quote)), cited, F.when(why != "", _text("    *Validator note:* ", why)))
    return heads.unionByName(first.select("key", ord_of("1", _padded("_rank")).alias("ord"), block.alias("block")))


def literature_blocks(key: str, lines: DataFrame) -> DataFrame:
    """A table row for every cited work of a project: title, year and citations as first retrieved, and the lines that cite it, in order."""
    used = lines.select(F.col(key).alias("key"), "seq", _or(F.col("line_id").cast("string"), "?").alias("line"), F.posexplode("citations").alias("pos", "work")).filter("work is not null")
    by = used.groupBy("key", "work").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "pos", "line"))), lambda x: F.concat(F.lit("#"), x["line"])), ", ").alias("refs"))
    works = lines.select(F.col(key).alias("key"), "seq", F.posexplode("retrieved_works").alias("pos", "w"))
    known = works.select("key", "seq", "pos", F.col("w.openalex_id").alias("work"), F.col("w.title").alias("title"), F.col("w.year").alias("year"), F.col("w.cited_by_count").alias("cited")).filter("work <> ''")
    first = known.groupBy("key", "work").agg(F.min_by(F.struct("title", "year", "cited"), F.struct("seq", "pos")).alias("w"))
    row = _text("| [", F.substring(_or("w.title", "(unknown)"), 1, TITLE_CHARS), "](https://openalex.org/", F.col("work"), ") | ", _or(F.nullif(F.col("w.year"), F.lit(0)).cast("string"), "—"),
                " | ", _or(F.col("w.cited").cast("string"), "—"), " | ", F.col("refs"), " |")
    return by.join(first, ["key", "work"], "left").select("key", F.array("work").alias("ord"), row.alias("block"))


def gaps() -> Column:
    """Lines of what a project lacks, in order; null where it lacks nothing. Needs agreements, has_token, markets, research_lead and kinds."""
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    none = F.coalesce(F.size("agreements"), F.lit(0)) <= 0
    tests = {"agreements": none, "development": ~none & ~F.coalesce(F.array_contains(F.col("agreements"), "Development Agreement"), F.lit(False)), "token": ~has("has_token"),
             "markets": has("has_token") & (F.coalesce("markets", F.lit(0)) == 0), "lead": F.lower(text_of("research_lead")).isin(*HIDDEN_NAMES), "pdf": ~has("pdf"), "crawl": ~has("crawl"), "video": ~has("video")}
    return F.nullif(F.concat_ws("\n", *[F.when(tests[name], F.lit("- " + said)) for name, said in GAPS.items()]), F.lit(""))


def project_document(key: str, projects: DataFrame, categories: DataFrame, chunks: DataFrame, extracted: DataFrame, lines: DataFrame, per_source: int = 12, page: str = "https://example.org/",
                     intro: Sequence[str] = INTRO, scoring: Sequence[str] = SCORING, closing: str = "*Generated by the review pipeline.*") -> DataFrame:
    """key, bytes, text: the audit of every project.

    projects: one row for a project: key, name, organization, item_id, review_date, composite_score, agreements (array of kinds), has_token, markets (a count), research_lead.
    categories: key, category, seq, score_pct, numerator, denominator, raw_numerator, raw_denominator, line_count, cluster_count. chunks: key, chunk_id, source_kind, domain, doc_title. extracted: key, a row
    a line. lines: key, line_id, seq, source_kind, domain, doc_title, verdict, text, verbatim_quote, rationale, category, line_type, weight,
    effective_weight, cluster_size, citations (array of ids), retrieved_works (array of openalex_id, title, year, cited_by_count).
    A source lists its first ``per_source`` lines with a listed verdict and says how many follow. Rows of other projects are left out and sources
    without chunks are not shown; a project without rows says so in each section; null fields get a placeholder; ties keep the order of seq and line_id;
    no projects give no rows. page is the address under which items are shown.
    """
    people = projects.withColumn("key", F.col(key))
    # item_id belongs to the address of a source
    found = sources(key, chunks, lines)
    flag = lambda k: F.max(F.col(f"kinds.{k}")).alias(k)
    add = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    totals = found.groupBy("key").agg(F.count("sample").alias("sources"), add("favorable"), add("unfavorable"), add("open"), flag("pdf"), flag("crawl"), flag("video"))
    taken = extracted.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("taken"))
    cited = literature_blocks(key, lines)
    whole = people.join(totals, "key", "left").join(taken, "key", "left").join(cited.groupBy("key").agg(F.count("*").alias("works")), "key", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    address = _text(page, "ipnft/", F.col("item_id"))
    head = _lines(
        _text("# Evidence audit · ", _or("name", "Unknown")), "", _text("**Organization:** ", _or("organization", "Unknown"), "  "),
        F.when(text_of(F.col("item_id").cast("string")) != "", _text("**IPNFT page:** [", address, "](", address, ")  ")), _text("**Review date:** ", _or("review_date", "?"), "  "),
        _text("**Composite score:** ", _or(F.col("composite_score").cast("string"), "(none)"), " / 100  "), "", *intro, "", "---", "", "## At a glance", "",
        _text("- Sources reviewed: **", zero("sources"), "**"), _text("- Lines extracted from those sources: **", zero("taken"), "**"),
        _text("- Lines that produced a clear verdict: **", zero("favorable") + zero("unfavorable"), "** (", zero("favorable"), " favorable, ", zero("unfavorable"), " unfavorable)"),
        _text("- Lines whose science could not be confirmed: **", zero("open"), "**"), "", "---", "", "## Category scores", "", *CATEGORY_TABLE)
    middle = _lines("", *scoring, "", "---", "", "## Sources reviewed", "", *SOURCES, "")
    works = _lines("---", "", "## Scientific literature consulted", "", F.when(zero("works") > 0, _lines(*LITERATURE, "", *WORK_TABLE)).otherwise(NO_CITATIONS))
    tail = _lines("", "---", "", "## What's missing", "", F.coalesce(gaps(), F.lit(NO_GAPS)), "", "---", "", closing, "")
    parts = F.array(*[F.struct(F.lit(no).alias("section"), block.alias("block")) for no, block in ((0, head), (2, middle), (4, works), (6, tail))])
    frame = whole.select("key", F.explode(parts).alias("p")).select("key", "p.section", F.array().cast("array<string>").alias("ord"), "p.block")
    number = lambda c: zero(F.col(c)).cast("string")
    row = _text("| ", F.col("category"), " | ", _or(F.col("score_pct").cast("string"), "n/a"), " | ", _two_places(F.col("numerator")), " / ", _two_places(F.col("denominator")), " | ", number("raw_numerator"), " / ",
                number("raw_denominator"), " | ", number("line_count"), " | ", number("cluster_count"), " |")
    table = categories.select(F.col(key).alias("key"), F.lit(1).alias("section"), F.array(_padded("seq"), text_of("category")).alias("ord"), row.alias("block"))
    listed = source_blocks(key, found.join(people.select("key", F.col("item_id")), "key"), lines, per_source, page).withColumn("section", F.lit(3))
    body = reduce(DataFrame.unionByName, [table, listed, cited.withColumn("section", F.lit(5))]).join(people.select("key"), "key", "left_semi")
    blocks = frame.unionByName(body).filter("block is not null")
    text = blocks.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", "ord", "block"))), lambda x: x["block"]), "\n").alias("text"))
    return text.select(F.col("key").alias(key), F.octet_length("text").cast("long").alias("bytes"), "text")
