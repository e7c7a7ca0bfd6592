"""Batch calls of an external model: one callable from a list of prompts to a list of answers.

Prompts are built from columns, distinct prompts are called once, and answers join back, so a copy group costs one call.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions.answers import clean_answer, json_field, parse_bullets, recover_json
from attestra.functions.columns import as_col, clamp, text_of
from attestra.functions.text import estimate_tokens, strip_space
from attestra.operators.lines import clean_findings, clean_lines, clean_verdicts
from attestra.session import cut_lineage

Model = Callable[[list[str]], list[str]]


def _call(fn: Model, prompts: list[str], retries: int, wait: float) -> list[str]:
    """Answers of a batch; after the last failure of the batch its prompts are tried one by one, then left empty."""
    for attempt in range(retries):
        try:
            answers = fn(prompts)
            return [a or "" for a in answers]
        except Exception:  # noqa: BLE001 - the callable is foreign code
            if attempt + 1 < retries:
                time.sleep(wait * 2 ** attempt)
    return [""] if len(prompts) == 1 else [a for p in prompts for a in _call(fn, [p], 1, 0.0)]


def model_map(df: DataFrame, prompt: Column, fn: Model, answer: str = "answer", cache: DataFrame | None = None, retries: int = 4, wait: float = 1.0, parallel: int | None = None,
              batch: int = 64) -> DataFrame:
    """Rows with the model's answer to their prompt; "" after the last retry. ``cache`` is (prompt_hash, answer).

    ``parallel`` bounds the tasks that call the model at one time.
    """
    keyed = df.withColumn("_prompt", prompt).withColumn("prompt_hash", F.sha2("_prompt", 256))
    todo = keyed.select("prompt_hash", "_prompt").dropDuplicates(["prompt_hash"])
    if cache is not None:
        todo = todo.join(cache.select("prompt_hash"), "prompt_hash", "left_anti")
    if parallel:
        todo = todo.repartition(parallel)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at:at + batch]
                yield pd.DataFrame({"prompt_hash": part["prompt_hash"], answer: _call(fn, part["_prompt"].tolist(), retries, wait)})

    fresh = todo.mapInPandas(run, f"prompt_hash string, {answer} string")
    known = fresh if cache is None else fresh.unionByName(cache.select("prompt_hash", F.col("answer").alias(answer)))
    return keyed.join(known, "prompt_hash", "left").drop("_prompt").withColumn(answer, F.coalesce(answer, F.lit("")))


# Verdicts and grades a model may give.
CLAIM_VERDICTS = ("supported", "unsupported", "insufficient_info")
EVIDENCE_GRADES = ("strong", "moderate", "weak", "unsupported", "unverifiable", "overclaim")


def verdicts(claims: DataFrame, full: Model, verdict_only: Model, rationale_only: Model, prompt: Column, **kw) -> DataFrame:
    """Claim verdicts with a fallback chain: JSON answer, then a verdict-only call, then a rationale-only call. Failed rows are flagged, never dropped."""
    first = cut_lineage(model_map(claims, prompt, full, "_full", **kw).drop("prompt_hash"))
    js = first.withColumn("_j", recover_json("_full"))
    verdict = F.lower(F.trim(F.get_json_object("_j", "$.verdict")))
    parsed = js.withColumns({"verdict": F.when(verdict.isin(*CLAIM_VERDICTS), verdict), "rationale": F.nullif(F.trim(F.get_json_object("_j", "$.rationale")), F.lit("")),
                             "relevancy_score": clamp(F.get_json_object("_j", "$.relevancy_score").try_cast("double"), 0.0, 1.0)}).drop("_full", "_j")
    good = parsed.filter("verdict IS NOT NULL AND rationale IS NOT NULL").withColumn("validation_error", F.lit(False))
    rest = parsed.filter("verdict IS NULL OR rationale IS NULL")
    second = model_map(rest, prompt, verdict_only, "_v", **kw).drop("prompt_hash")
    token = F.regexp_extract(F.lower("_v"), "(insufficient_info|unsupported|supported)", 1)
    second = second.withColumn("verdict", F.coalesce("verdict", F.nullif(token, F.lit("")))).drop("_v")
    third = model_map(second, F.concat_ws("\n", prompt, F.col("verdict")), rationale_only, "_r", **kw).drop("prompt_hash")
    third = third.withColumn("rationale", F.coalesce("rationale", F.nullif(F.trim(clean_answer("_r")), F.lit("")))).drop("_r")
    failed = F.col("verdict").isNull()
    flagged = third.withColumn("validation_error", failed).withColumn("verdict", F.coalesce("verdict", F.lit("validation_error")))
    return good.unionByName(flagged)


def grade_evidence(claims: DataFrame, prompt: Column, fn: Model, attempts: int = 3, **kw) -> DataFrame:
    """Grade and summary per claim; answers that do not parse are asked again, at last "unverifiable"."""
    done, todo = None, claims
    for attempt in range(attempts):
        again = F.lit("" if attempt == 0 else "\n\nOutput ONLY one JSON object." + " " * (attempt - 1))
        answered = model_map(todo, F.concat(prompt, again), fn, "_a", **kw).drop("prompt_hash")
        parsed = cut_lineage(answered.withColumn("_j", recover_json("_a")).drop("_a"))
        grade = F.get_json_object("_j", "$.evidence_grade")
        got = parsed.filter("_j IS NOT NULL").withColumns({"evidence_grade": F.coalesce(F.nullif(grade, F.lit("")), F.lit("unverifiable")), "evidence_summary": text_of(F.get_json_object("_j", "$.evidence_summary")),
                                                           "per_reference": F.get_json_object("_j", "$.per_reference")}).drop("_j")
        done = got if done is None else done.unionByName(got)
        todo = parsed.filter("_j IS NULL").drop("_j")
    lost = todo.withColumns({"evidence_grade": F.lit("unverifiable"), "evidence_summary": F.lit("Answer could not be parsed after retries."), "per_reference": F.lit(None).cast("string")})
    return done.unionByName(lost)


def extract_lines(chunks: DataFrame, prompt: Column, fn: Model, key: str = "chunk_id", k: int = 6, **kw) -> DataFrame:
    """Typed lines of every chunk from a JSON list answer."""
    a = model_map(chunks, prompt, fn, "_a", **kw).drop("prompt_hash").withColumn("_j", recover_json("_a", "array"))
    shape = "array<struct<line_type: string, text: string, verbatim_quote: string>>"
    raw = a.select(key, F.posexplode(F.from_json("_j", shape)).alias("pos", "_l")).select(key, "pos", "_l.*")
    return clean_lines(raw, [key], ["pos"], k)


def extract_claims(chunks: DataFrame, prompt: Column, fn: Model, key: str = "chunk_id", **kw) -> DataFrame:
    a = model_map(chunks, prompt, fn, "_a", **kw).drop("prompt_hash").withColumn("_j", recover_json("_a", "array"))
    return a.select(key, F.posexplode(F.from_json("_j", "array<struct<claim: string, claim_type: string>>")).alias("pos", "_c")).select(key, "pos", "_c.*").filter(F.trim(text_of("claim")) != "")


def validate_lines(lines: DataFrame, scientific: Model, stance: Model, sci_prompt: Column, stance_prompt: Column, flag: str = "needs_scientific_support", **kw) -> DataFrame:
    """Lines that need science go to one model with their works, the others to a stance model; verdicts are cleaned."""
    def part(df, prompt, fn):
        a = model_map(df, prompt, fn, "_a", **kw).drop("prompt_hash").withColumn("_j", recover_json("_a"))
        return a.withColumns({"verdict": F.get_json_object("_j", "$.verdict"), "citations": F.coalesce(F.from_json(F.get_json_object("_j", "$.citations"), "array<string>"), F.array().cast("array<string>")),
                              "rationale": F.substring(F.trim(text_of(F.get_json_object("_j", "$.rationale"))), 1, 500)}).drop("_a", "_j")
    both = part(lines.filter(F.col(flag)), sci_prompt, scientific).unionByName(part(lines.filter(~F.coalesce(F.col(flag), F.lit(False))), stance_prompt, stance))
    return clean_verdicts(both, flag)


def score_works(works: DataFrame, prompt: Column, fn: Model, default: float = 0.10, **kw) -> DataFrame:
    """Similarity of related works, clamped to 0..1, a default where the answer is no number."""
    a = model_map(works, prompt, fn, "_a", **kw).drop("prompt_hash")
    s = F.regexp_extract(clean_answer("_a"), r"(-?\d+(?:\.\d+)?)", 1).try_cast("double")
    return a.withColumn("similarity", F.coalesce(clamp(s, 0.0, 1.0), F.lit(default))).drop("_a")


def window_prompt(system_tokens: int, text, references, limit: int = 16384, answer_tokens: int = 1024) -> Column:
    """Prompt text within the context: references go first, then the text is cut to 60% of the room."""
    text, references = as_col(text), text_of(references)
    room = limit - answer_tokens - system_tokens
    both = F.concat_ws("\n\n", text, F.nullif(references, F.lit("")))
    cut = F.substring(text, 1, int(room * 0.6 * 3.2))
    return F.when(estimate_tokens(both) <= room, both).when(estimate_tokens(text) <= room, text).otherwise(cut)


def screen_windows(windows: DataFrame, prompt: Column, fn: Model, dimensions: Sequence[str], by: Sequence[str], **kw) -> DataFrame:
    """Findings per window from a JSON answer, cleaned."""
    a = model_map(windows, prompt, fn, "_a", **kw).drop("prompt_hash").withColumn("_j", json_field("_a", "findings"))
    shape = "array<struct<dimension: string, severity: string, observation: string, quote: string, section: string>>"
    return clean_findings(a.select(*by, F.posexplode(F.from_json("_j", shape)).alias("pos", "_f")).select(*by, "pos", "_f.*"), dimensions)


def classify_headings(chunks: DataFrame, prompt: Column, fn: Model, allowed: Sequence[str], heading: str = "section_heading", default: str = "other", **kw) -> DataFrame:
    """Section class per distinct heading, put back on the chunks; any case, unknown classes are "other"."""
    low = F.lower(F.trim(text_of(heading)))
    heads = chunks.select(low.alias("_h")).distinct()
    a = model_map(heads, prompt, fn, "_a", **kw)
    cls = F.lower(F.trim(clean_answer("_a")))
    named = a.select("_h", F.when(cls.isin(*allowed), cls).otherwise(default).alias("semantic_category"))
    return chunks.withColumn("_h", low).join(named, "_h", "left").drop("_h")


def payload(units: DataFrame, by: Sequence[str], fields: Sequence[str], order: Sequence, k: int = 12, name: str = "payload") -> DataFrame:
    """JSON object of the group's keys and its first k units, the user message of a group call."""
    from attestra.operators.ranking import first_rows
    top = first_rows(units, by, order, k, "_rank")
    unit = F.struct("_rank", F.struct(*fields).alias("u"))
    grouped = top.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(unit)), lambda s: s["u"]).alias("units"))
    return grouped.select(*by, F.to_json(F.struct(*by, "units")).alias(name))


def topic_summaries(groups: DataFrame, prompt: Column, fn: Model, **kw) -> DataFrame:
    return model_map(groups, prompt, fn, "_a", **kw).drop("prompt_hash").withColumn("bullets", parse_bullets("_a")).drop("_a")


def overview(reviews: DataFrame, fn: Model, by: Sequence[str], text: str = "rationale", **kw) -> DataFrame:
    """Plain-language copy of every text field of long reviews; numbers stay as they are, a failed call keeps the text."""
    a = model_map(reviews, F.col(text), fn, "_a", **kw).drop("prompt_hash")
    return a.withColumn(text, F.coalesce(F.nullif(F.trim(clean_answer("_a")), F.lit("")), F.col(text))).drop("_a")


# Article routes, in the order in which a bare answer is searched for them; the text taken without an abstract; a batch of works and its snippets.
ROUTES = ("empirical", "theoretical_narrative", "protocol")
ROUTE_CHARS = 6000
BATCH_WORKS = 25
SNIPPET_CHARS = 400


def route_text(docs: DataFrame, chunks: DataFrame, key: str, pos: str = "chunk_id", text: str = "text", category: str = "semantic_category", limit: int = ROUTE_CHARS) -> DataFrame:
    """docs with route_text: the abstract's chunks with a blank line between, else the first ``limit`` characters of the text without comments and rules.

    A document's abstract is one row, as large as it is itself. Blank chunks are skipped; repeated chunks stand twice; null texts give "".
    """
    said = strip_space(text_of(text))
    found = chunks.filter(F.col(category) == "abstract").select(key, F.col(pos).alias("_pos"), said.alias("_said")).filter("_said <> ''")
    joined = found.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_said"))), lambda s: s["_said"]), "\n\n").alias("_abstract"))
    plain = F.replace(F.regexp_replace(text_of(text), r"(?d)<!--.*?-->", ""), F.lit("\n---\n"), F.lit("\n"))
    return docs.join(joined, key, "left").withColumn("route_text", F.coalesce("_abstract", strip_space(F.substring(plain, 1, limit)))).drop("_abstract")


def route_of(answer, routes: Sequence[str] = ROUTES) -> Column:
    """Route in a model's answer: the article_type of its first flat JSON object, else the first route that the answer names; null where there is none or the object is broken."""
    answer = text_of(answer)
    braces = F.regexp_extract(answer, r"(\{[^}]+\})", 1)
    named = F.lower(strip_space(text_of(F.try_variant_get(F.try_parse_json(braces), "$.article_type", "string"))))
    bare = F.coalesce(*[F.when(F.contains(F.lower(answer), F.lit(r)), F.lit(r)) for r in routes])
    return F.when((braces != "") & F.try_parse_json(braces).isNull(), F.lit(None).cast("string")).when(named.isin(*routes), named).otherwise(bare)


def route_articles(docs: DataFrame, chunks: DataFrame, fn: Model, key: str = "doc_id", default: str = "empirical", attempts: int = 3, routes: Sequence[str] = ROUTES, text: str = "text", **kw) -> DataFrame:
    """docs with article_type: the model's route of their abstract or opening; what stays undecided is asked again, at last it is the default.

    Equal texts are asked once in a turn; empty texts are asked like others; null keys have no abstract; no rows give no rows.
    """
    todo, done = route_text(docs, chunks, key, text=text), None
    for _ in range(attempts):
        answered = model_map(todo, F.concat(F.lit("Classify this document:\n\n"), "route_text"), fn, "_a", **kw).drop("prompt_hash")
        routed = cut_lineage(answered.withColumn("article_type", route_of("_a", routes)).drop("_a"))
        good = routed.filter("article_type is not null")
        done = good if done is None else done.unionByName(good)
        todo = routed.filter("article_type is null").drop("article_type")
    return done.unionByName(todo.withColumn("article_type", F.lit(default))).drop("route_text")


def score_work_batches(works: DataFrame, papers: DataFrame, fn: Model, key: str, order: str, abstract: str = "abstract", size: int = BATCH_WORKS, snippet: int = SNIPPET_CHARS, default: float = 0.10, **kw) -> DataFrame:
    """works (key, a unique integer ``order``, title, year, abstract) with work_no and similarity: works of a paper go to the model ``size`` at a time and are answered by their number.

    papers: key and the paper's own abstract. A number answered twice keeps the last answer, also from a later batch; a zero, an unreadable score or
    none gives the default; scores are held to 0..1 and rounded to two places. Null titles, years and abstracts get a placeholder, papers without
    an abstract an empty one; works of a null key get the default; no works give no rows. Numbers run through blocks of the order, so no task holds a paper's works.
    """
    from attestra.operators.ranking import running
    numbered = cut_lineage(running(works, [key], order, 1, "work_no"))
    short = F.when(F.length(abstract) > snippet, F.concat(F.rtrim(F.substring(abstract, 1, snippet)), F.lit(" ..."))).otherwise(F.col(abstract))
    entry = F.concat(F.lit("\n["), F.col("work_no").cast("string"), F.lit("] "), F.coalesce(F.nullif(text_of("title"), F.lit("")), F.lit("(no title)")), F.lit(" ("), F.coalesce(F.col("year").cast("string"), F.lit("n.d.")),
                     F.lit(")\n   Abstract: "), F.coalesce(F.nullif(short, F.lit("")), F.lit("(not available)")))
    # at most ``size`` entries a batch
    batches = numbered.select(key, F.floor((F.col("work_no") - 1) / size).alias("batch"), "work_no", entry.alias("e")).groupBy(key, "batch").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("work_no", "e"))), lambda s: s["e"]), "\n").alias("entries"))
    own = papers.select(key, F.col(abstract).alias("_own"))
    prompt = F.concat(F.lit("PAPER ABSTRACT UNDER REVIEW:\n"), text_of("_own"), F.lit("\n\nRELATED WORKS TO SCORE:\n"), F.col("entries"))
    answered = model_map(batches.join(own, key, "left"), prompt, fn, "_a", **kw).select(key, "batch", recover_json("_a", "array").alias("_j"))
    got = answered.select(key, "batch", F.posexplode(F.from_json("_j", "array<struct<index: string, similarity_score: string>>")).alias("pos", "x"))
    number = F.col("x.similarity_score").try_cast("double")
    score = F.when((F.coalesce(F.col("x.similarity_score"), F.lit("")) == "") | (number == 0), F.lit(default)).otherwise(clamp(number, 0.0, 1.0))
    last = got.select(key, F.col("x.index").try_cast("double").cast("long").alias("work_no"), score.alias("s"), "batch", "pos").filter("work_no is not null and s is not null").groupBy(key, "work_no").agg(
        F.max_by("s", F.struct("batch", "pos")).alias("s"))
    return numbered.join(last, [key, "work_no"], "left").withColumn("similarity", F.round(F.coalesce("s", F.lit(default)), 2)).drop("s")
