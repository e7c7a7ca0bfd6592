"""Phrase collocation mining on a weighted de Bruijn graph (operator 12).

Nodes are three-word grams, edges four-word grams with their counts. A first scan counts word pairs by hash; those that are frequent go into a
bit table of fixed size. The second scan writes, for every place of a piece, the longest gram of up to four words all of whose pairs may be
frequent: four words are an edge, fewer are the end of a piece or of what can be frequent. Every occurrence of a frequent phrase is the
beginning of exactly one such gram, so shorter counts are what flows out of a node plus the ends at it: counts of three words from edges, of
two from those, of single words from those. Unary paths (nodes with one way in and one way out) are compacted to one row before their parts
are compared with them. All counts and comparisons are exact; hashes only choose what need not be looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestra.llm.common import query, stored, table
from attestra.llm.jaccard import U8, hashed_words, mixed

#: Signs that end a piece, and blanks between the words of a piece.
MARKS = b".,;:!?\n\x0b\x0c\r"
ENDS = np.isin(np.arange(256), list(MARKS))
APART = ENDS | np.isin(np.arange(256), list(b" \t"))
#: Words of an edge.
ORDER = 4
#: Bits of the table of pairs: its size does not depend on the data (8 MB).
BIT_WORDS = 1 << 20
#: Words and bytes that a task holds at a time.
HELD_WORDS, HELD_BYTES = 1_000_000, 8_000_000


class Stretch:
    """Words of some documents: hash, bytes, language, and whether the next word stands in the same piece."""

    def __init__(self, parts: list[bytes], langs: list[int]):
        self.data = b"\n".join(parts).lower()  # bytes.lower() changes A-Z alone
        self.hash, self.start, self.end = hashed_words(self.data, APART)
        at = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
        self.lang = np.array(langs, "<i4")[np.searchsorted(at, self.start, "right") - 1] if len(self.start) else np.zeros(0, "<i4")
        marks = np.concatenate([[0], np.cumsum(ENDS[np.frombuffer(self.data + b"\n", "u1")])])
        self.on = np.append(marks[self.start[1:]] == marks[self.end[:-1]], False) if len(self.start) else np.zeros(0, bool)

    def pair(self, langs: np.ndarray) -> np.ndarray:
        """Hash of every word with the one after it, by language."""
        return mixed(self.hash * U8(0x9E3779B97F4A7C15) + np.append(self.hash[1:], U8(0)) + langs[self.lang])


class Langs:
    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.hashes: list[int] = []

    def of(self, lang: str | None) -> int:
        lang = "und" if lang is None else lang
        if lang not in self.number:
            self.number[lang] = len(self.hashes)
            self.hashes.append(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))
        return self.number[lang]


def stretches(batches: Iterator[pa.RecordBatch], langs: Langs) -> Iterator[Stretch]:
    parts, which, size = [], [], 0
    for b in batches:
        for i in range(b.num_rows):
            text = b.column(1)[i].as_py()
            if text:
                parts.append(text.encode("utf-8", "surrogatepass"))
                which.append(langs.of(b.column(0)[i].as_py()))
                size += len(parts[-1]) + 1
            if size >= 1_000_000:
                yield Stretch(parts, which)
                parts, which, size = [], [], 0
    if parts:
        yield Stretch(parts, which)


def counted_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pair, n: hashes of pairs within pieces with their counts in a part of the task."""
    langs, held, n = Langs(), [], 0

    def out() -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.record_batch([pa.array(keys.view("i8")), pa.array(counts.astype("<i8"))], ["pair", "n"])

    for s in stretches(batches, langs):
        held.append(s.pair(np.array(langs.hashes, "u8"))[s.on])
        n += len(held[-1])
        if n >= HELD_WORDS:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def frequent_bits(rows: DataFrame, minimum: int) -> bytes:
    """A bit for the hash of every pair counted ``minimum`` times or more; other pairs may share it. At most ``BIT_WORDS`` rows reach the driver."""
    pairs = rows.mapInArrow(counted_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter(F.col("n") >= minimum)
    word = F.pmod(F.shiftrightunsigned("pair", 6), F.lit(BIT_WORDS)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("pair", F.lit(64)).cast("int"))
    got = pairs.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(BIT_WORDS, "<i8")
    bits[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return bits.tobytes()


def longest_grams(shared):
    """lang, k, gram, n: for every place the longest gram of maybe-frequent pairs that begins there, counted in a part of the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, langs, held, n = np.frombuffer(shared.value, "<u8"), Langs(), [], 0

        def out() -> pa.RecordBatch:
            names, lang, size, text = list(langs.number), [], [], []
            _, first, counts = np.unique(np.concatenate([g for _, g, _ in held]), return_index=True, return_counts=True)
            order = np.argsort(first)
            first, counts = first[order], counts[order]
            edges = np.cumsum([0] + [len(g) for _, g, _ in held])
            cuts = np.searchsorted(first, edges)
            for x, (s, _, k) in enumerate(held):
                at = first[cuts[x]:cuts[x + 1]] - edges[x]
                starts, ends = s.start.tolist(), s.end.tolist()
                text += [b" ".join([s.data[starts[w]:ends[w]] for w in range(i, i + m)]).decode("utf-8", "surrogatepass") for i, m in zip(at.tolist(), k[at].tolist(), strict=True)]
                size += k[at].tolist()
                lang += [names[i] for i in s.lang[at].tolist()]
            return pa.record_batch([pa.array(lang, pa.string()), pa.array(size, pa.int32()), pa.array(text, pa.string()), pa.array(counts.astype("<i8"))], ["lang", "k", "gram", "n"])

        for s in stretches(batches, langs):
            if not len(s.hash):
                continue
            hashes = np.array(langs.hashes, "u8")
            pair = s.pair(hashes)
            hit = (bits[((pair >> U8(6)) % U8(BIT_WORDS)).astype("<i8")] >> (pair & U8(63))) & U8(1)
            chain = s.on & (hit == 1)
            k, going, gram = np.ones(len(chain), "<i8"), np.ones(len(chain), bool), s.hash + hashes[s.lang]
            for j in range(1, ORDER):
                going = going & np.append(chain[j - 1:], np.zeros(j - 1, bool))
                at = np.flatnonzero(going)
                k[at] += 1
                gram[at] = mixed(gram[at] * U8(0x2545F4914F6CDD1D)) + s.hash[at + j]
            held.append((s, mixed(gram + k.astype("u8")), k))
            n += len(k)
            if n >= HELD_WORDS or sum(len(x.data) for x, _, _ in held) >= HELD_BYTES:
                yield out()
                held, n = [], 0
        if n:
            yield out()
    return run


def first_words(gram: str, k) -> F.Column:
    return F.call_function("substring_index", F.col(gram), F.lit(" "), F.lit(k) if isinstance(k, int) else k)


def flows(grams: DataFrame) -> dict[int, DataFrame]:
    """k -> lang, gram, n: counts of k words. Edges are the grams of four words; a node's count is its flow out plus the ends at it."""
    levels = {ORDER: stored(grams.filter(F.col("k") == ORDER).select("lang", "gram", "n"), "edges")}
    for k in range(ORDER - 1, 0, -1):
        out = levels[k + 1].select("lang", first_words("gram", k).alias("gram"), "n")
        ends = grams.filter(F.col("k") == k).select("lang", "gram", "n")
        levels[k] = stored(out.unionByName(ends).groupBy("lang", "gram").agg(F.sum("n").alias("n")), f"nodes-{k}")
    return levels


def compacted(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """lang, words (array), n: the unary paths of the graph; an edge that is on no longer path is one by itself.

    A node is passed through where one edge brings all its count and one takes all of it. Edges find the beginning of their path by doubling:
    each round is a written table, their number grows with the logarithm of the longest path. Pieces begin somewhere, so a path is no circle.
    One row holds one path, which is no longer than the longest repeated piece.
    """
    into = edges.select("lang", F.call_function("substring_index", "gram", F.lit(" "), F.lit(1 - ORDER)).alias("node"), "n", F.col("gram").alias("before"))
    out = edges.select("lang", first_words("gram", ORDER - 1).alias("node"), "n", "gram")
    through = nodes.select("lang", F.col("gram").alias("node"), "n")
    links = into.join(through, ["lang", "node", "n"]).join(out, ["lang", "node", "n"]).select("lang", "gram", "before")
    # up: the edge 'steps' before this one, as far as the path is known; a path's first edge has no up
    state = stored(edges.join(links, ["lang", "gram"], "left").select("lang", "gram", "n", F.col("before").alias("up"), F.when(F.col("before").isNull(), 0).otherwise(1).alias("steps")), "paths")
    while True:
        above = state.select("lang", F.col("gram").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("more"))
        if state.filter("up is not null").join(above.filter("up2 is not null"), ["lang", "up"], "left_semi").isEmpty():
            break
        state = stored(state.join(above, ["lang", "up"], "left").select("lang", "gram", "n", F.coalesce("up2", "up").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "paths")
    last = F.struct("steps", F.call_function("substring_index", "gram", F.lit(" "), F.lit(-1)).alias("word"))
    paths = state.groupBy("lang", F.coalesce("up", "gram").alias("head")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(last)).alias("tail"))
    words = F.concat(F.split("head", " "), F.transform(F.slice("tail", F.lit(2), F.size("tail")), lambda x: x["word"]))
    return paths.select("lang", words.alias("words"), "n")


def parts(words, k: int):
    """All contiguous phrases of k words of an array of at least k."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.array_join(F.slice(words, i, F.lit(k)), " "))


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", minimum: int = 30, covered: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two to four words.

    Candidates occur at least ``minimum`` times within pieces; one that stands in a longer candidate with at least ``covered`` percent of its
    count goes. The score is floor(2000000 * a / (l + r)) of the cut that makes it least, ties to the earliest cut. Null texts count as empty,
    a null language as ``und``; repeated rows count each time; other columns are not read; no rows give no rows. Equal scores are ordered by
    count, then by the phrase's bytes, so the result has one order.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    bits = docs.sparkSession.sparkContext.broadcast(frequent_bits(rows, minimum))
    grams = rows.mapInArrow(longest_grams(bits), "lang string, k int, gram string, n long").groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))
    levels = flows(stored(grams, "grams"))
    frequent = {k: df.filter(F.col("n") >= minimum) for k, df in levels.items()}
    counts = stored(frequent[1].unionByName(frequent[2]).unionByName(frequent[3]), "counts")
    paths = stored(compacted(frequent[ORDER], frequent[ORDER - 1]), "compacted")
    inner = F.concat(*[parts(F.col("words"), k) for k in range(2, ORDER)])
    covers = paths.select("lang", F.explode(inner).alias("gram"), "n").unionByName(frequent[3].select("lang", F.explode(parts(F.split("gram", " "), 2)).alias("gram"), "n"))
    covers = covers.groupBy("lang", "gram").agg(F.max("n").alias("cover"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")  # noqa: E731  products may pass 64 bits
    candidates = frequent[2].unionByName(frequent[3]).unionByName(frequent[ORDER])
    alone = candidates.join(covers, ["lang", "gram"], "left").filter(F.col("cover").isNull() | (exact("cover") * 100 < exact("n") * covered))
    size = F.size(F.split("gram", " "))
    cut = alone.select("lang", "gram", F.col("n").alias("a"), size.alias("size"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cut = cut.select("*", first_words("gram", F.col("k")).alias("first"), F.call_function("substring_index", "gram", F.lit(" "), F.col("k") - F.col("size")).alias("rest"))
    side = lambda name, n: counts.select("lang", F.col("gram").alias(name), F.col("n").alias(n))
    cut = cut.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"])
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cut.groupBy("lang", "gram", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x")).select("lang", F.col("gram").alias("phrase"), "a", "x.l", "x.r", "x.score")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).filter(F.col("rank") <= top)
    totals = levels[1].groupBy("lang").agg(F.sum("n").alias("n"))  # one row a language
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
with words as (
  select lang, [x for x in regexp_split_to_array(piece, '[ \t]+') if x <> ''] as w
  from (select coalesce(lang, 'und') as lang,
          unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
        from documents)),
grams as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as a
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from words, (values (1), (2), (3), (4)) as s(k))
  group by 1, 2, 3),
totals as (select lang, sum(a)::bigint as n from grams where k = 1 group by lang),
candidates as (select * from grams where k >= 2 and a >= 30),
inner_parts as (
  select lang, a, array_to_string(w[i:i + m - 1], ' ') as phrase
  from (select lang, a, k, w, m, unnest(range(1, k - m + 2)) as i
        from (select lang, a, k, string_split(phrase, ' ') as w, unnest(range(2, k)) as m from candidates where k > 2))),
covers as (select lang, phrase, max(a) as cover from inner_parts group by 1, 2),
alone as (
  select c.* from candidates c left join covers v on v.lang = c.lang and v.phrase = c.phrase
  where v.cover is null or 100::hugeint * v.cover < 80::hugeint * c.a),
cut as (
  select lang, phrase, a, j, array_to_string(w[1:j], ' ') as first_part, array_to_string(w[j + 1:], ' ') as rest
  from (select lang, phrase, a, string_split(phrase, ' ') as w, unnest(range(1, k)) as j from alone)),
scored as (
  select c.lang, c.phrase, c.a, x.a as l, y.a as r, j, ((2000000::hugeint * c.a) // (x.a + y.a))::bigint as score
  from cut c join grams x on x.lang = c.lang and x.phrase = c.first_part join grams y on y.lang = c.lang and y.phrase = c.rest),
least as (select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from least)
select r.lang, rank, phrase, a, l, r.r, t.n, score from ranked r join totals t on t.lang = r.lang where rank <= 2000
"""


@query("op12_de_bruijn_phrases", SQL)
def op12_de_bruijn_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents"))
