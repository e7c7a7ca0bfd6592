"""Ranked lexical search, term at a time for short lists and document at a time over long ones (operator 13).

A first scan writes an inverted index: each task turns blocks of documents into posting lists of the terms that items may use (a bit table of
fixed size tells) and stores them in the shared folder. Document frequencies and lengths are sums over the stored blocks. Every block is then
searched for all items, which are read from the shared folder in batches. An item's short lists are summed into accumulators; these are one
iterator with the largest sum as its bound, beside the long lists with theirs. Windows of documents are scored in order: only iterators whose
bounds can reach the tenth best score propose documents, the others are looked into where a document can still get there. Blocks return their
ten best for each item, and a ranked window keeps the ten best of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestra.llm.bpe import pack, unpack
from attestra.llm.common import query, shared_path, table
from attestra.llm.jaccard import U8, hashed_words

#: Bytes between terms: ASCII that is neither a digit nor a letter.
APART = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Bits of the table of item terms: its size does not depend on the data (8 MB).
BIT_WORDS = 1 << 20
#: A block of documents ends at either bound.
BLOCK_DOCS, BLOCK_CHARS = 16_384, 16_000_000
#: Documents of a window; a list is short if it holds at most one document in so many of the block.
WINDOW, SHORT = 2048, 16
#: Items of a batch, and items whose tenth best score so far a worker remembers.
ITEM_BATCH, KNOWN_ITEMS = 1000, 100_000


def term_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Hashes of the terms of each text."""
    for t in texts:
        yield hashed_words(t.encode("utf-8", "surrogatepass"), APART)[0] if t else np.zeros(0, "u8")


def block_terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of some texts, and the place of each one's text; texts are hashed in runs of about a megabyte."""
    hashes, places, first = [np.zeros(0, "u8")], [np.zeros(0, "<i8")], 0
    while first < len(texts):
        parts, size, last = [], 0, first
        while last < len(texts) and (last == first or size < 1_000_000):
            parts.append((texts[last] or "").encode("utf-8", "surrogatepass"))
            size += len(parts[-1]) + 1
            last += 1
        got, starts, _ = hashed_words(b" ".join(parts), APART)
        at = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
        hashes.append(got)
        places.append(first + np.searchsorted(at, starts, "right") - 1)
        first = last
    return np.concatenate(hashes), np.concatenate(places)


def item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item, term, repeats of every item (a long) and text."""
    for b in batches:
        for item, w in zip(b.column(0).to_pylist(), term_hashes(b.column(1).to_pylist()), strict=True):
            if len(w):
                terms, repeats = np.unique(w, return_counts=True)
                yield pa.record_batch([pa.array(np.full(len(terms), item, "<i8")), pa.array(terms.view("i8")), pa.array(repeats.astype("<i8"))], ["item", "term", "repeats"])


def term_bits(terms: DataFrame) -> bytes:
    """A bit for every term hash; other terms may share it. At most ``BIT_WORDS`` rows reach the driver."""
    word = F.pmod(F.shiftrightunsigned("term", 6), F.lit(BIT_WORDS)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("term", F.lit(64)).cast("int"))
    got = terms.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(BIT_WORDS, "<i8")
    bits[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return bits.tobytes()


def indexed(shared):
    """The index: doc_ids (ascending), lengths, terms, dfs, and the lists' places and occurrences, one row for a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, "<u8")
        ids: list = []
        texts: list[str | None] = []
        size, kind = 0, None

        def flush() -> pa.RecordBatch:
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, *([] if ids[i] is None else [ids[i]]), i))
            hashes, place = block_terms([texts[i] for i in order])
            n = np.bincount(place, minlength=len(ids))
            hit = ((bits[((hashes >> U8(6)) % U8(BIT_WORDS)).astype("<i8")] >> (hashes & U8(63))) & U8(1)) == 1
            terms, which = np.unique(hashes[hit], return_inverse=True)
            key, occurs = np.unique(which * len(ids) + place[hit], return_counts=True)
            dfs = np.bincount(key // len(ids), minlength=len(terms))
            column = pa.array([ids[i] for i in order], kind)
            offsets = pa.array([0, len(ids)], pa.int32())
            lists = lambda a, t: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a.astype(t)))
            return pa.record_batch([pa.ListArray.from_arrays(offsets, column), lists(n, "<i8"), lists(terms.view("i8"), "<i8"), lists(dfs, "<i8"),
                                    pa.array([pack((key % len(ids)).astype("<u4"))], pa.binary()), pa.array([pack(occurs.astype("<u4"))], pa.binary())],
                                   ["doc_ids", "lengths", "terms", "dfs", "places", "occurs"])

        for b in batches:
            kind = b.column(0).type
            for doc_id, text in zip(b.column(0), b.column(1), strict=True):
                ids.append(doc_id.as_py())
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if len(ids) >= BLOCK_DOCS or size >= BLOCK_CHARS:
                    yield flush()
                    ids, texts, size = [], [], 0
        if ids:
            yield flush()
    return run


class Best:
    """The ``top`` best documents of one item in one block; ``floor`` is what a score has to reach."""

    def __init__(self, top: int, floor: int):
        self.top, self.floor = top, floor
        self.scores, self.places = np.zeros(0, "<i8"), np.zeros(0, "<i8")

    def add(self, scores: np.ndarray, places: np.ndarray) -> None:
        scores, places = np.concatenate([self.scores, scores]), np.concatenate([self.places, places])
        order = np.lexsort((places, -scores))[:self.top]
        self.scores, self.places = scores[order], places[order]
        if len(order) == self.top:
            self.floor = max(self.floor, int(self.scores[-1]))


class Block:
    """One block of the index in memory."""

    def __init__(self, row: dict, n_docs: int, total: int):
        lengths = np.array(row["lengths"], "<i8")
        self.doc_ids = row["doc_ids"]
        self.size = len(lengths)
        if 75 * int(lengths.max(initial=0)) * n_docs < 1 << 63:
            m = 25 + (75 * lengths * n_docs) // max(total, 1)
        else:
            m = np.array([25 + 75 * n * n_docs // total for n in lengths.tolist()], "<i8")
        dfs = np.array(row["dfs"], "<i8")
        self.terms = {t: i for i, t in enumerate(row["terms"])}
        self.ends = np.concatenate([[0], np.cumsum(dfs)])
        self.places = unpack(row["places"], "<u4").astype("<i8")
        tf = unpack(row["occurs"], "<u4").astype("<i8")
        self.part = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.places])
        self.most = np.maximum.reduceat(self.part, self.ends[:-1]) if len(dfs) else self.part
        self.windows = np.arange(0, self.size + WINDOW, WINDOW)

    def search(self, terms: list[int], weights: list[int], top: int, floor: int) -> Best:
        """Documents with a score of at least ``floor`` (and above 0) that are among the block's ``top`` best."""
        found = [(self.terms[t], w) for t, w in zip(terms, weights, strict=True) if t in self.terms and w > 0]
        lists = [(self.ends[i], self.ends[i + 1], w, int(self.most[i]) * w) for i, w in found]
        short = [x for x in lists if (x[1] - x[0]) * SHORT <= self.size]
        sources = [(self.places[a:b], self.part[a:b], w, bound) for a, b, w, bound in lists if (b - a) * SHORT > self.size]
        best = Best(top, max(floor, 1))
        if short:  # term at a time: the short lists become one
            places = np.concatenate([self.places[a:b] for a, b, _, _ in short])
            sums = np.concatenate([self.part[a:b] * w for a, b, w, _ in short])
            order = np.argsort(places, kind="stable")
            places, sums = places[order], sums[order]
            first = np.flatnonzero(np.diff(places, prepend=-1))
            places, sums = places[first], np.add.reduceat(sums, first)
            sources.append((places, sums, 1, int(sums.max())))
            if len(sums) >= top:  # no score is less than what the short lists give
                best.floor = max(best.floor, int(np.partition(sums, len(sums) - top)[len(sums) - top]))
        sources.sort(key=lambda x: x[3])
        reach = np.cumsum([x[3] for x in sources]).tolist()  # what the first 1, 2, ... sources can give together
        edges = None
        for k in range(len(self.windows) - 1):
            first = next((i for i, r in enumerate(reach) if r >= best.floor), None)
            if first is None:
                break
            if edges is None:
                edges = [np.searchsorted(x[0], self.windows) for x in sources]
            start = k * WINDOW
            score, seen = np.zeros(WINDOW, "<i8"), np.zeros(WINDOW, bool)
            for (places, part, w, _), e in zip(sources[first:], edges[first:], strict=True):
                at = places[e[k]:e[k + 1]] - start
                score[at] += part[e[k]:e[k + 1]] * w
                seen[at] = True
            place = np.flatnonzero(seen)
            for i in range(first - 1, -1, -1):
                place = place[score[place] + reach[i] >= best.floor]
                if not len(place):
                    break
                (places, part, w, _), e = sources[i], edges[i]
                window = places[e[k]:e[k + 1]]
                if len(window):
                    at = np.minimum(np.searchsorted(window, place + start), len(window) - 1)
                    hit = window[at] == place + start
                    score[place[hit]] += part[e[k] + at[hit]] * w
            place = place[score[place] >= best.floor]
            if len(place):
                best.add(score[place], place + start)
        return best


def read_batches(folder: str, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a Parquet table in the shared folder, in bounded batches."""
    fs, root = pafs.FileSystem.from_uri(folder)
    for info in sorted(fs.get_file_info(pafs.FileSelector(root)), key=lambda f: f.path):
        if info.path.endswith(".parquet"):
            with fs.open_input_file(info.path) as source:
                yield from pq.ParquetFile(source).iter_batches(ITEM_BATCH, columns=columns)


def searched(folder: str, n_docs: int, total: int, top: int):
    """item, doc_id, score of a block's best for every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[int, int] = {}
        for b in batches:
            kind = b.column("doc_ids").type.value_type
            for i in range(b.num_rows):
                block = Block(b.slice(i, 1).to_pylist()[0], n_docs, total)
                for items in read_batches(folder, ["item", "terms", "weights"]):
                    out = []
                    for x in items.to_pylist():
                        best = block.search(x["terms"], x["weights"], top, floors.get(x["item"], 0))
                        if len(floors) >= KNOWN_ITEMS:
                            floors.clear()
                        floors[x["item"]] = best.floor
                        out.append((x["item"], best))
                    names = np.repeat(np.array([n for n, _ in out], "<i8"), [len(x.scores) for _, x in out])
                    places = np.concatenate([x.places for _, x in out])
                    yield pa.record_batch([pa.array(names), pa.array([block.doc_ids[p] for p in places.tolist()], kind), pa.array(np.concatenate([x.scores for _, x in out]))],
                                          ["item", "doc_id", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id", top: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: for each item its ``top`` best documents with a score above 0, equal scores by ascending id.

    Terms are maximal runs of digits, ASCII letters (A-Z in lower case) and other characters beyond ASCII. Null and empty texts have no terms and
    count for nothing; a null document id comes last among equal scores; repeated ids are documents of their own; items that repeat id and
    text count once, items that share an id but no text are ranked each; other columns are not read; no documents or items give no rows.
    Terms are named by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).dropDuplicates().withColumn("item", F.xxhash64("item_id", "text"))
    folder = shared_path(spark, "lexical")
    asked.select("item", "text").mapInArrow(item_terms, "item long, term long, repeats long").write.parquet(f"{folder}/terms")
    terms = spark.read.parquet(f"{folder}/terms")
    bits = spark.sparkContext.broadcast(term_bits(terms))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows.mapInArrow(indexed(bits), f"doc_ids array<{kind}>, lengths array<long>, terms array<long>, dfs array<long>, places binary, occurs binary").write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    sizes = index.select(F.explode("lengths").alias("n")).agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    df = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.dfs").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * sizes.docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long") * F.col("repeats")
    weighed = terms.join(df, "term").select("item", F.struct(F.col("term"), weight.alias("weight")).alias("x")).groupBy("item").agg(F.collect_list("x").alias("x"))  # the terms of one item
    weighed.select("item", F.col("x.term").alias("terms"), F.col("x.weight").alias("weights")).write.parquet(f"{folder}/items")
    found = index.mapInArrow(searched(f"{folder}/items", sizes.docs, sizes.total, top), f"item long, doc_id {kind}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


SQL = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents),
asked as (
  select item_id, term, count(*) as repeats
  from (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from benchmark)
  group by 1, 2),
occurs as (select doc_id, term, count(*) as tf from words where term in (select term from asked) group by 1, 2),
lengths as (select doc_id, count(*) as n from words group by 1),
sizes as (select count(*) as docs, sum(n)::bigint as total from lengths),
weights as (select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from occurs, sizes group by term),
scored as (
  select a.item_id, o.doc_id, sum(a.repeats * w.w * ((1000000000 * o.tf) // (1000 * o.tf + 8 * (25 + (75 * l.n * s.docs) // s.total))))::bigint as score
  from asked a join occurs o on o.term = a.term join weights w on w.term = a.term join lengths l on l.doc_id = o.doc_id, sizes s
  group by 1, 2)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from scored where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10
"""


@query("op13_hybrid_search", SQL)
def op13_hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
