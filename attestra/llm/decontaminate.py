"""Benchmark decontamination by SimHash windows (operator 2).

Every document is read in windows of the items' sizes. A window's SimHash over its word pairs is looked up in a multi-index: 64 bits in
blocks, every item entered under all values near its own, so that any fingerprint within the radius shares an entry in some block. What
is found is verified by the exact weighted similarity of word shingles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from attestra.llm.common import query, table
from attestra.llm.jaccard import U8, all_words, mixed, word_hashes

BLOCKS, NEAR = 4, 3
#: Every fingerprint within this many bits is found: with more than NEAR differing bits in each block there were BLOCKS * (NEAR + 1).
RADIUS = BLOCKS * (NEAR + 1) - 1
#: Items of sizes within this ratio share their windows; windows start at every STEP-th part of their size.
SIZE_RATIO, STEP = 1.1, 16
BATCH_WORDS = 40_000  # of texts that are read together


def pair_bits(w: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of 64 bits of each word pair; a single word is its own pair."""
    pairs = mixed(w[:-1] * U8(3) + w[1:]) if len(w) > 1 else mixed(w)
    return (np.unpackbits(pairs.view("u1").reshape(-1, 8), axis=1).astype("i1") << 1) - 1


def fingerprint(w: np.ndarray) -> np.ndarray:
    return np.packbits(pair_bits(w).sum(axis=0, dtype="i4") > 0)


def runs(w: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place on; of all words where there are fewer."""
    k = min(len(w), width)
    total = np.full(len(w) - k + 1, k, "u8")
    for j in range(k):
        total = mixed(total * U8(0x2545F4914F6CDD1D) + w[j:len(w) - k + 1 + j])
    return total


def weights(w: np.ndarray, width: int) -> Counter:
    """Shingles of ``width`` words (fewer words: all of them) with their number of occurrences."""
    return Counter(runs(w, width).tolist()) if len(w) else Counter()


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: the sum of the lesser over the sum of the greater occurrences."""
    common = sum((a & b).values())
    whole = sum(a.values()) + sum(b.values()) - common
    return common / whole if whole else 0.0


@dataclass
class Group:
    """Items of near sizes: least and window size, step, fingerprints and for each block of bits the values near an item's."""

    least: int
    size: int
    step: int
    prints: np.ndarray
    items: np.ndarray
    near: np.ndarray


class Index:
    """The multi-index over one set of items; items without words are never found."""

    def __init__(self, items: list[tuple[int, str]], width: int, threshold: float):
        self.width, self.threshold = width, threshold
        self.ids = [i for i, _ in items]
        self.words = [word_hashes(t) for _, t in items]
        self.weights = [weights(w, width) for w in self.words]
        self.groups: list[Group] = []
        order = sorted((len(w), k) for k, w in enumerate(self.words) if len(w))
        flips = np.array([0] + [sum(1 << b for b in c) for r in range(1, NEAR + 1) for c in combinations(range(16), r)], "u2")
        while order:
            low = order[0][0]
            members = [k for n, k in order if n <= max(low, int(low * SIZE_RATIO))]
            order = order[len(members):]
            size = (len(self.words[members[0]]) + len(self.words[members[-1]]) + 1) // 2
            prints = np.array([fingerprint(self.words[k]) for k in members])
            near = np.zeros((BLOCKS, 1 << 16), bool)
            for block in range(BLOCKS):
                near[block, (np.ascontiguousarray(prints).view("u2")[:, block, None] ^ flips).ravel()] = True
            self.groups.append(Group(low, size, max(1, size // STEP), np.ascontiguousarray(prints).view("u8")[:, 0], np.array(members), near))

    def candidates(self, w: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, items) of windows within RADIUS of an item, over texts laid end to end. A text a little shorter than a window is one window."""
        bits, ending = pair_bits(w), np.repeat(ends, ends - starts)
        sums: dict[str, np.ndarray] = {}

        def summed(span: int) -> np.ndarray:
            kind = "i1" if span < 127 else "i2" if span < 32767 else "i4"  # differences over fewer pairs are right modulo the type
            if kind not in sums:
                sums[kind] = np.zeros((len(bits) + 1, 64), kind)
                np.cumsum(bits, axis=0, dtype=kind, out=sums[kind][1:])
            return sums[kind]

        def matched(g: Group, difference: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return near(g, np.packbits(difference > 0, axis=1), places)

        def near(g: Group, prints: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            value = prints.view("u2")
            hit = g.near[0][value[:, 0]]
            for block in range(1, BLOCKS):
                hit |= g.near[block][value[:, block]]
            at = np.flatnonzero(hit)
            far = np.bitwise_count(prints.view("u8")[at] ^ g.prints[None, :])
            i, k = np.nonzero(far <= RADIUS)
            return places[at[i]], g.items[k]

        for g in self.groups:
            if g.size == 1:  # a word by itself
                yield near(g, mixed(w).view("u1").reshape(-1, 8), np.arange(len(w)))
                continue
            span = g.size - 1
            table_of, n = summed(span), len(bits) + 1 - span
            if n > 0:
                grid = np.arange(0, n, g.step)
                places, items = matched(g, table_of[span::g.step][:len(grid)] - table_of[:n:g.step], grid)
                inside = places + g.size <= ending[np.minimum(places, len(ending) - 1)]
                yield places[inside], items[inside]
            long = ends - starts >= g.size
            last = (ends - g.size)[long]
            if g.step > 1 and len(last):
                yield matched(g, table_of[last + span] - table_of[last], last)
            short = ~long & (ends - starts >= self.threshold * g.least)  # long enough for the smallest item
            if short.any():
                first, final = starts[short], np.maximum(ends[short] - 1, starts[short] + 1)
                yield matched(g, table_of[np.minimum(final, len(table_of) - 1)] - table_of[first], first)

    def found(self, texts: list[str]) -> list[dict[int, float]]:
        """For each text the items it holds, with the similarity of the best window of the item's own size."""
        out: list[dict[int, float]] = [{} for _ in texts]
        hashed = list(all_words(texts))
        first = 0
        while first < len(texts):
            last, n = first, 0
            while last < len(texts) and (last == first or n + len(hashed[last]) <= BATCH_WORDS):
                n += len(hashed[last])
                last += 1
            if n:
                self._search(hashed[first:last], out[first:last])
            first = last
        return out

    def _search(self, hashed: list[np.ndarray], out: list[dict[int, float]]) -> None:
        sizes = np.array([len(w) for w in hashed])
        ends = np.cumsum(sizes)
        starts, used = ends - sizes, sizes > 0
        w = np.concatenate(hashed)
        shingle = runs(w, self.width)
        tried: set[tuple[int, int]] = set()
        for places, items in self.candidates(w, starts[used], ends[used]):
            for place, k in zip(places.tolist(), items.tolist(), strict=True):
                doc = int(np.searchsorted(ends, place, "right"))
                size, weight = len(self.words[k]), self.weights[k]
                slack = max(2, size // 8)
                low, high = max(int(starts[doc]), place - slack), min(int(ends[doc]), place + size + slack)
                if size >= self.width and high - low >= self.width:
                    # occurrences in the item of the shingles of all windows around: too few and no window reaches the threshold
                    around = set(shingle[low:high - self.width + 1].tolist())
                    if sum(n for s, n in weight.items() if s in around) < self.threshold * weight.total() - 1e-9:
                        continue
                for at in range(low, max(low, min(place + slack, int(ends[doc]) - size)) + 1):
                    if (at, k) in tried:
                        continue
                    tried.add((at, k))
                    s = similarity(weight, weights(w[at:min(at + size, int(ends[doc]))], self.width))
                    if s >= self.threshold and s > out[doc].get(self.ids[k], 0):
                        out[doc][self.ids[k]] = s


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 5, threshold: float = 0.8,
          block: int = 2000, name: str = "leaks") -> DataFrame:
    """All rows and columns of docs and ``leaks``: array of (item_id, similarity), by item, empty where the text holds no item.

    An item counts when a window of its size has a weighted ``width``-word shingle similarity of ``threshold`` or more. The benchmark is the
    stated query set: it goes to the tasks in blocks of ``block`` items, each a pass over the documents. Null and empty texts hold nothing;
    null, empty and repeated items: without words they are never found, repeated ids report their best; ties cannot arise, a column of the
    name is replaced, no items leave every array empty and no rows give no rows.
    """
    docs = docs.drop(name)
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).filter("i is not null and t is not null").orderBy("i", "t")
    items = [(r.i, r.t) for r in rows.toLocalIterator()]
    item = StructType([StructField("item_id", LongType()), StructField("similarity", DoubleType())])
    at, names = docs.columns.index(text), [*docs.columns, name]
    column = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64())]))
    out = docs
    for first in range(0, max(len(items), 1), block):
        part = items[first:first + block]

        def run(batches: Iterator[pa.RecordBatch], part=part, again=first > 0) -> Iterator[pa.RecordBatch]:
            index = Index(part, width, threshold)
            for b in batches:
                got = index.found([t or "" for t in b.column(at).to_pylist()])
                if again:
                    for g, old in zip(got, b.column(len(names) - 1).to_pylist(), strict=True):
                        for x in old:
                            g[x["item_id"]] = max(x["similarity"], g.get(x["item_id"], 0))
                columns = list(b.columns)[:len(names) - 1]
                yield pa.record_batch([*columns, pa.array([[{"item_id": k, "similarity": s} for k, s in sorted(g.items())] for g in got], column)], names)

        out = out.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, ArrayType(item))]))
    return out


@query("op2_simhash_decontamination")
def op2_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.transform("leaks", lambda x: x["item_id"]).alias("item_ids"),
                      F.array_max(F.transform("leaks", lambda x: x["similarity"])).alias("similarity"))
