"""Quality rules on cross-document line frequency (operator 6), DataFrame functions only.

Normalised lines are hashed, the distinct documents of every host are counted for each hash, lines above the limit go, and documents that
lose too much are rejected. Base rules on words, symbols and repetition come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.llm.common import query, stored, table

GAP = r"[ \t-\r]+"  # between words
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, GAP, -1), lambda w: w != "")


def normalised(line: Column) -> Column:
    """Lower case, single blanks, every digit as 0: page numbers and dates do not hide a repeated line."""
    return F.lower(F.regexp_replace(F.trim(F.regexp_replace(line, GAP, " ")), "[0-9]", "0"))


def line_list(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^ \t-\r]")))


def bound(value: Column, fn) -> Column:
    """fn of a value that is computed once: a lambda's own variable, so that inner lambdas do not compute it again for every element."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words in windows of ``WINDOW`` words found twice or more in the text, first included. Windows are compared by 64-bit hashes and
    sorted with their places, so a text takes n log n steps; a text without a repeated window stops after the count of distinct ones."""
    windows = bound(F.transform(words, lambda w: F.xxhash64(w)), lambda c: F.when(F.size(c) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(c) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(c, i, WINDOW)))))
    placed = lambda w: F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda s, k, h: F.get(s, k)["h"].eqNullSafe(h)
    twice = lambda s: F.array_sort(F.transform(F.filter(s, lambda x, k: same(s, k - 1, x["h"]) | same(s, k + 1, x["h"])), lambda x: x["i"]))
    covered = lambda t: F.aggregate(F.transform(t, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(t, k + 1) - x, F.lit(WINDOW)))),
                                    F.lit(0).cast("long"), lambda a, x: a + x)
    count = bound(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), bound(placed(w), lambda s: bound(twice(s), covered))))
    return F.coalesce(count, F.lit(0).cast("long"))


def measures(docs: DataFrame) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of column body."""
    words, lines = words_of(F.col("body")), line_list(F.col("body"))
    return docs.withColumns({
        "n_words": F.size(words).cast("long"), "word_chars": F.length(F.regexp_replace("body", GAP, "")).cast("long"),
        "n_symbols": (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"), "n_repeat_words": repeated_words(words)})


def frequent_lines(docs: DataFrame, limit: int) -> DataFrame:
    """(host, line hash) of normalised lines in more than ``limit`` rows of the host: all that can be in more than ``limit`` documents. docs: host, body."""
    hashes = F.array_distinct(F.transform(line_list(F.col("body")), lambda x: F.xxhash64(normalised(x))))
    return docs.select("host", F.explode(hashes).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > limit)


def line_rules(docs: DataFrame, text: str = "text", host: str = "source", id_col: str = "doc_id", limit: int = 100, min_left: float = 0.5,
               min_words: int = 20, max_repeat: float = 0.3, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, the five measures, base_failed, kept, and with ``with_text`` cleaned, the text without its frequent lines.

    limit: documents of one host that may share a line. A document is depleted, and not kept, when less than ``min_left`` of its words, or
    fewer than ``min_words``, remain. Null texts count as empty (and fail), a null host is a host of its own, rows of the same id are one
    document when documents are counted, rows without an id one for each text; every row gets its own verdict, rows that repeat id, host and
    text the same one; other columns are not read; no rows give no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.xxhash64(F.col(host).cast("string")), F.lit(0)).alias("host"), body.alias("body")).withColumn(
        "row", F.xxhash64(F.col("doc_id").cast("string"), "host", "body"))
    rows = rows.withColumn("doc", F.when(F.col("doc_id").isNull(), F.col("row")).otherwise(F.xxhash64(F.col("doc_id").cast("string"))))
    # rows bound documents from above, so a count of rows with map-side sums finds the few lines whose documents are then counted exactly;
    # both are stored, so that the planner knows their sizes when it picks the joins
    often = stored(frequent_lines(rows, limit).select("host", "line"), "lines")
    each = F.transform(line_list(F.col("body")), lambda x: F.struct(F.xxhash64(normalised(x)).alias("line"), F.size(F.split(normalised(x), " ")).alias("n")))
    found = rows.select("row", "doc", "host", F.posexplode(each).alias("at", "x")).select("row", "doc", "host", "at", "x.*").join(often, ["host", "line"])
    hits = stored(found.dropDuplicates(["row", "at"]), "line-hits")  # repeated rows have hit together
    frequent = hits.groupBy("host", "line").agg(F.count_distinct("doc").alias("n_docs")).filter(F.col("n_docs") > limit)
    gone = hits.join(frequent, ["host", "line"], "left_semi").groupBy("row").agg(F.collect_set("line").alias("gone"), F.sum("n").alias("lost"))
    base = (measures(rows) if with_text else measures(rows).drop("body")).drop("doc")
    out = base.join(gone, "row", "left").withColumn("left", F.col("n_words") - F.coalesce("lost", F.lit(0)))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * int(round(max_repeat * 100)))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("left") >= min_words) & (F.col("left") >= F.col("n_words") * min_left))
    cleaned = F.array_join(F.filter(F.split("body", "\n", -1), lambda x: ~F.coalesce(F.array_contains("gone", F.xxhash64(normalised(x))), F.lit(False))), "\n")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *([cleaned.alias("cleaned")] if with_text else []))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, host, t, list_filter(string_split_regex(t, '[ \t-\r]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n_repeat_words FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
l AS (SELECT doc_id, host, lower(regexp_replace(trim(regexp_replace(x, '[ \t-\r]+', ' ', 'g')), '[0-9]', '0', 'g')) AS line FROM (SELECT doc_id, host, unnest(ls) AS x FROM w)),
often AS (SELECT host, line FROM l GROUP BY host, line HAVING count(DISTINCT doc_id) > 100),
lost AS (SELECT doc_id, sum(len(string_split(line, ' '))) AS lost FROM l JOIN often USING (host, line) GROUP BY doc_id),
m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[ \t-\r]+', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(ws) - coalesce(lost, 0) AS rest FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND rest >= 20 AND rest >= 0.5 * n_words AS kept FROM m"""


@query("op6_line_frequency", ORACLE)
def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules(table(spark, sf_dir, "documents"))
