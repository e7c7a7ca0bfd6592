"""Feeds, profiles, posts, files and configuration as tables; JSON sinks and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.functions.columns import blank_to_null, text_of
from attestra.functions.html import html_to_text, strip_tags
from attestra.functions.text import collapse, safe_id, split_headings, strip_front_matter, token_amount
from attestra.functions.urls import encode_path, keep_link, mirror_url, page_url, site_name
from attestra.operators.packing import pack_text
from attestra.operators.ranking import first_rows
from attestra.session import cut_lineage

POST_SCHEMA = "channel struct<item: array<struct<title: string, link: string, guid: string, pubDate: string, description: string>>>"


# --- S1 ---------------------------------------------------------------------------------------------
def parse_jsonl(lines: DataFrame, text: str = "value", strict: bool = False) -> DataFrame:
    """JSON objects of text lines as VARIANT; blank and broken lines are skipped, or an error when strict."""
    filled = lines.filter(F.trim(F.col(text)) != "")
    parsed = filled.withColumn("record", (F.parse_json if strict else F.try_parse_json)(F.col(text)))
    return parsed.filter(F.startswith(F.schema_of_variant("record"), F.lit("OBJECT"))).drop(text)


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None, strict: bool = False) -> DataFrame:
    if schema is not None:
        return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)
    return parse_jsonl(spark.read.text(path), strict=strict)


# --- S5, S6 -----------------------------------------------------------------------------------------
def paper_records(feed: DataFrame, detail: DataFrame, authors: DataFrame | None, base: str = "https://www.researchhub.com") -> DataFrame:
    """Paper records: every field of the detail first, the feed's second; page and PDF URLs; authors in feed order."""
    fields = ("title", "abstract", "doi", "work_type", "slug", "created_date", "paper_publish_date")
    f = feed.select("paper_id", "action_date", *[F.col(c).alias(f"_f_{c}") for c in fields])
    d = detail.select("paper_id", "pdf_url", *[F.col(c).alias(f"_d_{c}") for c in fields])
    got = lambda c: F.coalesce(F.nullif(F.col(f"_d_{c}"), F.lit("")), F.col(f"_f_{c}"))
    out = f.join(d, "paper_id", "left").select("paper_id", page_url(base, "paper", F.col("paper_id"), got("slug")).alias("url"), encode_path("pdf_url").alias("pdf_url"),
                                               *[got(c).alias(c) for c in fields if c != "slug"], "action_date")
    if authors is None:
        return out
    names = authors.withColumn("name", F.trim(F.concat_ws(" ", F.trim(text_of("first_name")), F.trim(text_of("last_name"))))).filter("name <> ''")
    listed = names.groupBy("paper_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name", "author_id"))), lambda a: F.struct(a["name"].alias("name"), a["author_id"].alias("author_id"))).alias("authors"))
    return out.join(listed, "paper_id", "left")


def proposal_records(feed: DataFrame, detail: DataFrame, base: str = "https://www.researchhub.com") -> DataFrame:
    """Proposal records with amounts, dates and the plain text of the body."""
    d = detail.select("id", F.col("title").alias("_dt"), F.col("created_date").alias("_dc"), "document_type", "full_markdown")
    return feed.join(d, "id", "left").select(
        "id", F.coalesce(F.nullif(F.col("_dt"), F.lit("")), F.col("title")).alias("title"), F.col("amount_raised.usd").alias("amount_raised"), F.col("goal_amount.usd").alias("goal_amount"),
        F.col("contributors.total").alias("contributor_count"), F.coalesce("_dc", "created_date").alias("post_created"), "start_date", "end_date",
        F.coalesce("type", "document_type").alias("type"), page_url(base, "post", F.col("id"), F.col("slug"), "post").alias("url"), F.coalesce(html_to_text("full_markdown", ()), F.lit("")).alias("body"))


# --- S7, S19 ----------------------------------------------------------------------------------------
def markdown_documents(files: DataFrame, path: str, text: str, order: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Documents keyed by file stem; a stem with a dot is the domain; the first copy of a name counts."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    first = first_rows(files.withColumn("_name", name), [*by, "_name"], order)
    return first.select(*by, path, stem.alias("stem"), F.when(F.contains(stem, F.lit(".")), stem).otherwise("").alias("domain"), strip_front_matter(text).alias("text")).filter(F.trim("text") != "")


def pack_markdown(docs: DataFrame, stem: str, text: str, at: str) -> None:
    """Writes markdown documents with their paths, many to a file: a folder of one small file each costs a directory, a commit and a listed status a document, all of them through the driver."""
    path = F.concat(F.lit("stem="), F.col(stem).cast("string"), F.lit("/"), F.col(stem).cast("string"), F.lit(".md"))
    docs.select(path.alias("path"), F.col(text).alias("text")).write.parquet(at)


def read_packed(spark: SparkSession, at: str) -> DataFrame:
    """The documents that ``pack_markdown`` wrote, by the rules of files; a null text is an empty file."""
    packed = spark.read.schema("path string, text string").parquet(at)
    return markdown_documents(packed.select("path", text_of("text").alias("text")), "path", "text", ["path"])


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return markdown_documents(files, "path", "text", ["path"])


def text_chunks(documents: DataFrame, source_kind: str, max_chars: int = 3200) -> DataFrame:
    s = documents.select("stem", "domain", F.posexplode(split_headings("text")).alias("_s", "_sec")).filter(F.trim("_sec.body") != "")
    c = s.select("stem", "domain", "_s", F.col("_sec.heading").alias("section"), F.posexplode(pack_text(F.col("_sec.body"), max_chars)).alias("_c", "text"))
    return _chunk(c, source_kind, F.concat_ws(":", F.lit(source_kind), safe_id("stem"), F.concat(F.lit("s"), "_s"), F.concat(F.lit("c"), "_c")), F.col("stem"))


def _chunk(df: DataFrame, kind: str, chunk_id: Column, title: Column, page: Column | None = None) -> DataFrame:
    domain = F.col("domain") if "domain" in df.columns else F.lit("")
    return df.select(chunk_id.alias("chunk_id"), F.lit(kind).alias("source_kind"), title.alias("doc_title"), domain.alias("domain"),
                     (page if page is not None else F.lit(None)).cast("int").alias("page"), "section", "text")


def bundle_chunks(pdf: DataFrame, images: DataFrame, frames: DataFrame, max_chars: int = 3200) -> DataFrame:
    """Chunk rows of a processed bundle: PDF sections, one caption per image, transcript packs and frame lines per video.

    pdf(stem, title, sections array<struct<heading, text, page_start>>), images(stem, description, transcribed, labels array),
    frames(stem, pos, ts, audio, description, embedded).
    """
    from attestra.operators.packing import pack_transcript
    s = pdf.select("stem", "title", F.posexplode("sections").alias("_s", "_sec"))
    heading = F.coalesce(F.nullif(F.col("_sec.heading"), F.lit("")), F.concat(F.lit("Section "), (F.col("_s") + 1).cast("string")))
    p = s.select("stem", "title", "_s", heading.alias("section"), F.col("_sec.page_start").alias("page"), F.posexplode(pack_text(F.col("_sec.text"), max_chars)).alias("_c", "text"))
    pdf_rows = _chunk(p, "pdf", F.concat_ws(":", F.lit("pdf"), safe_id("stem"), F.concat(F.lit("s"), "_s"), F.concat(F.lit("c"), "_c")), F.col("title"), F.col("page"))
    labels = F.when(F.size("labels") > 0, F.concat(F.lit("Labels: "), F.array_join("labels", ", ")))
    caption = F.concat_ws("\n", F.concat(F.lit("Description: "), blank_to_null("description")), F.concat(F.lit("Embedded text: "), blank_to_null("transcribed")), labels)
    i = images.withColumn("text", caption).filter("text <> ''").withColumn("section", F.lit("image"))
    image_rows = _chunk(i, "image_caption", F.concat_ws(":", F.lit("image"), safe_id("stem"), F.lit("c0")), F.col("stem"))
    t = pack_transcript(frames.select("stem", "pos", "audio").withColumn("audio", text_of("audio")), ["stem"], "pos", "audio", max_chars).withColumn("section", F.lit("audio"))
    audio_rows = _chunk(t, "video_transcript", F.concat_ws(":", F.lit("video"), safe_id("stem"), F.concat(F.lit("t"), "pack")), F.col("stem"))
    line = F.concat(F.lit("["), F.col("ts").cast("string"), F.lit("s] "), F.trim(text_of("description")), F.coalesce(F.concat(F.lit(" | embedded text: "), blank_to_null("embedded")), F.lit("")))
    shown = frames.filter((F.trim(text_of("description")) != "") | (F.trim(text_of("embedded")) != ""))
    joined = shown.groupBy("stem").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("l")))), lambda x: x["l"]), "\n").alias("_t"))
    v = joined.select("stem", F.lit("frames").alias("section"), F.posexplode(pack_text("_t", max_chars)).alias("_c", "text"))
    frame_rows = _chunk(v, "video_frame", F.concat_ws(":", F.lit("video"), safe_id("stem"), F.concat(F.lit("f"), "_c")), F.col("stem"))
    return pdf_rows.unionByName(image_rows).unionByName(audio_rows).unionByName(frame_rows)


# --- S8 ---------------------------------------------------------------------------------------------
def rss_posts(feeds: DataFrame, keep: Sequence[str], xml: str = "xml", limit: int = 20) -> DataFrame:
    """Post rows of RSS documents: the first items, those with neither text nor link dropped."""
    items = F.slice(F.from_xml(F.col(xml), POST_SCHEMA)["channel"]["item"], 1, limit)
    i = feeds.select(*keep, F.posexplode(items).alias("pos", "_i"))
    link = F.trim(text_of("_i.link"))
    text = F.coalesce(F.nullif(strip_tags("_i.description"), F.lit("")), F.trim(text_of("_i.title")))
    ref = F.coalesce(F.nullif(link, F.lit("")), F.trim(text_of("_i.guid")))
    return i.select(*keep, "pos", F.nullif(F.regexp_extract(ref, r"/status/(\d+)", 1), F.lit("")).alias("post_id"), F.nullif(link, F.lit("")).alias("url"),
                    blank_to_null("_i.pubDate").alias("published"), text.alias("text"), F.nullif(F.regexp_extract(ref, r"(?i)nitter\.net/@?([^/]+)", 1), F.lit("")).alias("author")).filter(
        "text <> '' OR url IS NOT NULL")


# --- S9, S10 ----------------------------------------------------------------------------------------
def _p(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("profile", f"$.{path}", kind)


def profile_meta(profiles: DataFrame, key: str) -> DataFrame:
    named = lambda *cols: F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])
    return profiles.select(key, named(_p("symbol"), _p("ipnft.initialSymbol")).alias("symbol"), named(_p("ipnft.name")).alias("name"), named(_p("ipnft.organization")).alias("organization"),
                           F.coalesce(named(_p("ipnft.researchLead.name")), F.lit("Anonymous")).alias("research_lead"), named(_p("ipnft.topic")).alias("topic"))


def profile_facts(profiles: DataFrame, key: str, links: Column | None = None) -> DataFrame:
    """One fact line per topic of a project profile."""
    show = lambda c: F.coalesce(c, F.lit("None"))
    say = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else show(x) for x in parts])
    name, symbol = _p("ipnft.name"), F.coalesce(F.nullif(_p("symbol"), F.lit("")), _p("ipnft.initialSymbol"))
    lead, mail = _p("ipnft.researchLead.name"), _p("ipnft.researchLead.email")
    trl, why = _p("ipnft.trlValue"), _p("ipnft.trlRationale")
    amount, decimals = _p("ipnft.fundingAmountValue"), _p("ipnft.fundingAmountDecimals", "int")
    scaled = F.when(F.coalesce(decimals, F.lit(0)) == 0, amount).otherwise(token_amount(amount, decimals).cast("string"))
    agreements = _p("ipnft.agreements", "array<variant>")
    types = F.array_join(F.transform(agreements, lambda a: F.coalesce(F.try_variant_get(a, "$.type", "string"), F.lit("?"))), ", ")
    has_ipt = F.startswith(F.schema_of_variant(_p("ipnft.ipt", "variant")), F.lit("OBJECT<")) & (F.to_json(_p("ipnft.ipt", "variant")) != "{}")
    markets = F.coalesce(F.size(_p("ipnft.ipt.markets", "array<variant>")), F.lit(0))
    m = lambda k: _p(f"ipnft.ipt.markets[0].{k}")
    when = [_p(f"ipnft.{k}") for k in ("createdAt", "mintedAt", "updatedAt")]
    urls = F.slice(F.array_sort(F.array_distinct(F.filter(links, lambda u: u != ""))), 1, 30) if links is not None else F.array().cast("array<string>")
    set_ = lambda c: F.coalesce(c, F.lit("")) != ""
    facts = [
        ("identity", set_(name) | set_(symbol), say("IPNFT name: ", name, ". Symbol: ", symbol, ". Organization: ", _p("ipnft.organization"), ". Topic: ", _p("ipnft.topic"), ".")),
        ("description", set_(_p("ipnft.description")), say("Project description (from on-chain metadata): ", collapse(_p("ipnft.description")))),
        ("research_lead", set_(lead) | set_(mail), say("Research lead listed on-chain: name=", lead, ", email=", mail, ".")),
        ("trl", trl.isNotNull() | set_(why), say("Technology Readiness Level: ", trl, ". Rationale: ", collapse(F.coalesce(F.nullif(why, F.lit("")), F.lit("not provided"))), ".")),
        ("funding", amount.isNotNull(), say("Funding amount on-chain: ", scaled, " ", F.coalesce(_p("ipnft.fundingAmountCurrency"), F.lit("")), ".")),
        ("agreements", F.size(agreements) > 0, say("On-chain agreements present (", F.size(agreements).cast("string"), "): ", types, ".")),
        ("agreements_missing", agreements.isNull() | (F.size(agreements) <= 0), F.lit("No on-chain legal agreements listed for this IPNFT.")),
        ("tokenomics", has_ipt, say("IPT symbol: ", _p("ipnft.ipt.symbol"), ". Holder count: ", _p("ipnft.ipt.holderCount"), ". Total issued: ", _p("ipnft.ipt.totalIssued"), ". Markets: ", markets.cast("string"),
                                    ". Primary market liquidity (USD): ", m("liquidityUsd"), ". Primary market cap (USD): ", m("marketCapUsd"), ". Primary 24h volume (USD): ", m("tradingVolume24hr"), ".")),
        ("tokenomics_missing", ~F.coalesce(has_ipt, F.lit(False)), F.lit("No IPT (IP Token) issued for this IPNFT.")),
        ("timeline", set_(when[0]) | set_(when[1]) | set_(when[2]), say("Created: ", when[0], ". Minted: ", when[1], ". Last updated on-chain: ", when[2], ".")),
        ("external_links", F.size(urls) > 0, say("External links registered with the IPNFT: ", F.array_join(urls, "; "))),
    ]
    rows = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(k).alias("section"), t.alias("text"))) for k, c, t in facts]))
    return profiles.select(key, F.explode(rows).alias("_f")).select(key, F.lit("onchain_fact").alias("source_kind"), "_f.section", "_f.text")


# --- H16 --------------------------------------------------------------------------------------------
def walk_urls(documents: DataFrame, key: str, value: str, depth: int | None = None, kept_only: bool = True) -> DataFrame:
    """Every URL string inside nested JSON with its nearest named field; one explode per level until no nested rows are left.

    With ``depth`` set, deeper nesting is an error, never a silent loss.
    """
    level = documents.select(key, F.col(value).alias("_v"), F.lit(None).cast("string").alias("title"))
    found, levels = None, 0
    while True:
        hit = level.filter(F.schema_of_variant("_v") == "STRING").select(key, "title", F.trim(F.try_variant_get("_v", "$", "string")).alias("url")).filter(
            F.col("url").rlike("(?i)^(https?://|ipfs://)"))
        found = hit if found is None else found.unionByName(hit)
        nested = level.filter(F.schema_of_variant("_v").rlike("^(OBJECT|ARRAY)<"))
        level = cut_lineage(nested.lateralJoin(nested.sparkSession.tvf.variant_explode(F.col("_v").outer())).select(
            nested[key], F.col("value").alias("_v"), F.coalesce(F.col("key"), F.col("title")).alias("title")))
        levels += 1
        if level.isEmpty():
            break
        if depth is not None and levels >= depth:
            raise ValueError(f"documents nest deeper than {depth} levels")
    out = found.withColumn("url", mirror_url("url")).withColumn("site_name", site_name("url"))
    return out.filter(keep_link("url", "title")) if kept_only else out


# --- S11..S14 ---------------------------------------------------------------------------------------
def load_mappings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Tag map and dimension weights of a configuration file as two small tables."""
    doc = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    table = lambda field, name, kind: doc.select(F.explode(F.try_variant_get("v", f"$.{field}", f"map<string,{kind}>")).alias(name, "value"))
    return table("tag_index", "tag", "string").withColumnRenamed("value", "dimension"), table("dimension_weights", "dimension", "double").withColumnRenamed("value", "weight")


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One folder per value; rows of a value stay spread over the tasks that hold them."""
    df.write.mode(mode).partitionBy(*by).format(fmt).save(path)


def review_documents(categories: DataFrame, header: DataFrame, key: str) -> DataFrame:
    """One JSON object per item: header fields, then a map of its categories."""
    entry = F.struct(F.col("dimension"), F.struct("score", "rationale"))
    cats = categories.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("categories"))
    fields = [c for c in header.columns if c != key]
    return header.join(cats, key, "left").select(key, F.to_json(F.struct(*fields, "categories")).alias("document"))


def write_documents(documents: DataFrame, path: str) -> None:
    documents.select(F.col("document").alias("value")).write.mode("overwrite").text(path)


def manifest(df: DataFrame, errors: DataFrame, by: Sequence[str], item: str) -> DataFrame:
    """Counts and id range of a run per group, with its failures."""
    ok = df.groupBy(*by).agg(F.count("*").alias("items"), F.min(item).alias("first_id"), F.max(item).alias("last_id"))
    bad = errors.groupBy(*by).agg(F.count("*").alias("errors"), F.min_by("reason", item).alias("first_error"))
    return ok.join(bad, list(by), "full_outer").select(*by, F.coalesce("items", F.lit(0)).alias("items"), "first_id", "last_id", F.coalesce("errors", F.lit(0)).alias("errors"), "first_error")

