"""Exact Jaccard join of word n-gram sets by a pigeonhole over a partitioned universe (operator 10).

Sets fall into size bands. Within a band's scheme the universe of shingles is hashed into segments; two sets that link differ in at most H
shingles, so with enough segments some segment holds the same subset in both, or, where the scheme allots one deletion to a segment,
subsets that differ in one shingle. Keys of subsets and of one-deletion neighbours meet in a join; every candidate is verified on the
whole sets. A set with too many empty segments for the pigeonhole is also indexed by its prefix, so no link is lost.
"""

from __future__ import annotations

import functools
import hashlib
import math
import operator
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestra.llm.common import narrow_batches, query, stored, table
from attestra.llm.components import merged

U8 = np.uint64
_seed = np.random.default_rng(20)
BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LETTER = _seed.integers(1, 1 << 63, 256, dtype="u8") * U8(2) + U8(1)
POWER = np.multiply.accumulate(np.where(np.arange(4096) == 0, U8(1), U8(0x9E3779B97F4A7C15)))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> U8(30))) * U8(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U8(27))) * U8(0x94D049BB133111EB)
    return x ^ (x >> U8(31))


def hashed_words(data: bytes, apart: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first bytes and ends of all words of UTF-8 text; ``apart`` marks the bytes between words, a blank among them."""
    x = np.frombuffer(data.lower() + b" ", "u1")  # bytes.lower() changes A-Z alone
    blank = apart[x]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, "u8"), starts, ends
    place = np.arange(starts[0], len(x)) - np.repeat(starts, np.diff(np.append(starts, len(x))))
    value = LETTER[x[starts[0]:]]
    value *= POWER[place & 4095]
    if place.max() > 4095:  # a longer word tells its stretches of 4096 bytes apart
        value *= (place >> 12).astype("u8") * U8(2) + U8(1)
    value[blank[starts[0]:]] = 0
    return mixed(np.add.reduceat(value, starts - starts[0]) + (ends - starts).astype("u8") * U8(0xD6E8FEB86659FD93)), starts, ends


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case."""
    return hashed_words(text.encode("utf-8", "surrogatepass"))[0]


def all_words(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Word hashes of each text; texts are hashed together in runs of about a megabyte."""
    first = 0
    while first < len(texts):
        parts, size, last = [], 0, first
        while last < len(texts) and (last == first or size < 1_000_000):
            parts.append((texts[last] or "").encode("utf-8", "surrogatepass"))
            size += len(parts[-1]) + 1
            last += 1
        hashes, starts, _ = hashed_words(b" ".join(parts))
        edges = np.searchsorted(starts, np.cumsum([0] + [len(p) + 1 for p in parts]))
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            yield hashes[i:j]
        first = last


def column_words(texts: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of each text of a column, of which a slice at a time becomes Python objects."""
    for i in range(0, len(texts), SLICE):
        yield from all_words(texts.slice(i, SLICE).to_pylist())


def shingle_set(w: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct shingles of a text's words as 64-bit hashes; fewer words are one shingle, no words none."""
    n = len(w)
    if n == 0:
        return w
    k = min(n, width)
    total = np.full(n - k + 1, k, "u8")
    for j in range(k):
        total *= U8(0x2545F4914F6CDD1D)
        total += w[j:n - k + 1 + j]
        total = mixed(total)
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def shingles(text: str, width: int) -> np.ndarray:
    return shingle_set(word_hashes(text), width)


def set_hash(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if 100 * small < percent * large:
        return False
    if len(a) > len(b):
        a, b = b, a
    common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


class Schemes:
    """Size bands with their segments. A scheme serves the pairs whose smaller set is in its band."""

    RATIO = 1.5
    #: Cost of an index row, of a chance match of two segments and of a row of the prefix index.
    ROW, MATCH, PREFIX = 1.0, 200.0, 2.0
    #: Chance that a shingle of a segment is also in the other set's segment, for sets that do not link.
    SHARED = 0.05

    def __init__(self, percent: int):
        self.percent = percent

    @lru_cache(maxsize=None)  # noqa: B019
    def band(self, size: int) -> tuple[int, int]:
        low, high = 1, 1
        while size > high:
            low, high = high + 1, max(high + 1, int((high + 1) * self.RATIO))
        return low, high

    @lru_cache(maxsize=None)  # noqa: B019
    def of(self, low: int, high: int) -> tuple[int, int, int]:
        """H (most shingles in which a linked pair differs), segments, and how many of them have one-deletion neighbours, at the least cost."""
        p, most = self.percent, 0
        for total in range(2 * low, high + high * 100 // p + 1):
            most = max(most, total - 2 * -(-p * total // (100 + p)))
        best = None
        size = (low + high) / 2
        for deletions in range(most + 2):
            for spare in sorted({0, 1, 2, 3, 5, 8, most // 16, most // 8, most // 4, most // 2}):
                plain = max(0, most + 1 + spare - 2 * deletions)
                m = plain + deletions
                if m == 0 or deletions > 64:
                    continue
                g = size / m
                empty, single = math.exp(-g), g * math.exp(-g)
                # capacity: one for each plain segment in use, two for one with neighbours (one if it holds a single shingle)
                mean = plain * (1 - empty) + deletions * (2 * (1 - empty) - single)
                spread = math.sqrt(m * empty * (1 - empty) + deletions * single + 1e-9)
                weak = 0.5 * math.erfc((mean - (most + 1) + 0.5) / spread / math.sqrt(2)) if m > 1 else 0.0
                matches = math.exp(-g * (1 - self.SHARED)) - empty
                cost = self.ROW * (m + deletions * g) + self.MATCH * (m * matches + deletions * g * matches) + self.PREFIX * weak * size * (100 - p) / 100 * 10
                if best is None or cost < best[0]:
                    best = (cost, m, deletions)
        return most, best[1], best[2]

    def keys(self, s: np.ndarray) -> np.ndarray:
        """All keys of a set: one for each segment in use of each scheme it can meet a partner in, one for each deletion, and prefixes where the pigeonhole falls short."""
        size, out = len(s), []
        low, high = self.band(-(-self.percent * size // 100))
        while low <= size:
            most, m, deletions = self.of(low, high)
            tag = U8(low * 0xA0761D6478BD642F % (1 << 64))
            segment = (mixed(s + tag) >> U8(33)).astype("i8") % m
            value = mixed(s ^ U8(0x5851F42D4C957F2D))
            order = np.argsort(segment, kind="stable")
            seg, val = segment[order], value[order]
            first = np.flatnonzero(np.diff(seg, prepend=-1))
            total, count, which = np.add.reduceat(val, first), np.diff(np.append(first, size)), seg[first]
            place = tag + (which.astype("u8") + U8(1)) * U8(0xE7037ED1A0B428DB)
            out.append(mixed(total + place))
            capacity = int((which >= deletions).sum() + np.minimum(count[which < deletions], 2).sum())
            if deletions:
                near = np.repeat(which < deletions, count) & np.repeat(count > 1, count)
                out.append(mixed((np.repeat(total + place, count) - val)[near]))
            if capacity < most + 1:  # shingles in hash order; linked sets share one of the first size - overlap + 1
                rank = np.sort(mixed(s + U8(77)))
                out.append(mixed(rank[:size - -(-self.percent * size // 100) + 1] + tag + U8(0x1F123BB5)))
            low, high = self.band(high + 1)
        return np.unique(np.concatenate(out))


    def spare(self, s: np.ndarray) -> Iterator[tuple[int, bool, np.ndarray]]:
        """The second index: for each scheme how many keys have to be looked up, whether the set does so as the smaller of a pair, and the keys of twice as many segments.

        Sets that link differ in fewer segments than are looked up, empty ones included, whichever these are: so the rarest can be taken.
        """
        size = len(s)
        low, high = self.band(-(-self.percent * size // 100))
        while low <= size:
            need = self.of(low, high)[0] + 1
            tag = U8(low * 0xA0761D6478BD642F % (1 << 64)) ^ U8(0x2545F4914F6CDD1D)
            total = np.zeros(2 * need, "u8")
            np.add.at(total, (mixed(s + tag) >> U8(33)).astype("i8") % (2 * need), mixed(s ^ U8(0x5851F42D4C957F2D)))
            yield need, high >= size, mixed(total + tag + np.arange(1, 2 * need + 1).astype("u8") * U8(0xE7037ED1A0B428DB))
            low, high = self.band(high + 1)


#: Texts that a task turns into Python objects at a time.
SLICE = 256
#: 64-bit words of a set's parity sketch.
SKETCH = 16
PARTS = [f"s{i}" for i in range(SKETCH)]


#: Most bits of a wide sketch; a longer one would only rule out more.
WIDEST = 1 << 17


def wide_sketch(s: np.ndarray) -> np.ndarray:
    """Parities of how many shingles fall on each bit: two sketches differ in no more bits than their sets in shingles. Bits are a power of two, about one a shingle."""
    bits = 64 * SKETCH
    while bits < min(len(s), WIDEST):
        bits *= 2
    at = (mixed(s ^ U8(0x3C6EF372FE94F82B)) >> U8(20)).astype("i8") % bits
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype("u1"))


def folded(wide: np.ndarray, size: int) -> np.ndarray:
    """The sketch of the same set with fewer bits, in ``size`` bytes."""
    return np.bitwise_xor.reduce(wide.reshape(-1, size), axis=0)


def sketch(s: np.ndarray) -> np.ndarray:
    """The sketch of 1024 bits."""
    return folded(wide_sketch(s), 8 * SKETCH).view("i8")


def within(a: np.ndarray, b: np.ndarray, total: int, percent: int) -> bool:
    """Whether wide sketches leave a link possible for two sets of ``total`` shingles in all; exact, as it is a bound."""
    size = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum()) <= total - 2 * -(-percent * total // (100 + percent))


def measured(width: int):
    """doc_id, row, n_shingles, node (the hash of the whole set, null without shingles), the set's sketch, and the wide one where that is longer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, nodes, sketches, wides = [], [], [], []
            for w in column_words(b.column("text")):
                s = shingle_set(w, width)
                sizes.append(len(s))
                nodes.append(set_hash(s) if len(s) else None)
                wide = wide_sketch(s)
                sketches.append(folded(wide, 8 * SKETCH).view("i8"))
                wides.append(wide.tobytes() if len(wide) > 8 * SKETCH else None)
            parts = np.array(sketches, "i8").reshape(-1, SKETCH)
            yield pa.record_batch([b.column("doc_id"), b.column("row"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), *[pa.array(parts[:, i]) for i in range(SKETCH)], pa.array(wides, pa.binary())],
                                  ["doc_id", "row", "n_shingles", "node", *PARTS, "wide"])
    return run


def may_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes and sketches of two nodes (aliases a and b) leave a link possible; exact, as both are bounds."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = x + y - 2 * F.ceil((x + y) * percent / F.lit(float(100 + percent)) - 1e-9)
    apart_by = functools.reduce(operator.add, (F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in PARTS))
    return (F.least(x, y) * 100 >= F.greatest(x, y) * percent) & (apart_by <= most)


def indexed(width: int, percent: int):
    """key, node: the index rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemes = Schemes(percent)
        for b in batches:
            keys, nodes, n = [], [], 0
            for w in column_words(b.column(0)):
                s = shingle_set(w, width)
                if len(s):
                    keys.append(schemes.keys(s))
                    nodes.append(set_hash(s))
                    n += len(keys[-1])
                if n > 200_000:
                    yield _key_batch(keys, nodes)
                    keys, nodes, n = [], [], 0
            if keys:
                yield _key_batch(keys, nodes)
    return run


def spared(width: int, percent: int):
    """key, node, need: the second index; need is null where the set is not the one that looks up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemes = Schemes(percent)
        for b in batches:
            for node, w in zip(b.column("node").to_pylist(), column_words(b.column("text")), strict=True):
                for need, asks, keys in schemes.spare(shingle_set(w, width)):
                    n = len(keys)
                    yield pa.record_batch([pa.array(keys.view("i8")), pa.array(np.full(n, node, "i8")), pa.array(np.full(n, need, "i4"), mask=np.full(n, not asks))], ["key", "node", "need"])
    return run


def _key_batch(keys: list[np.ndarray], nodes: list[int]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.concatenate(keys).view("i8")), pa.array(np.repeat(np.array(nodes, "i8"), [len(k) for k in keys]))], ["key", "node"])


def checked(width: int, percent: int):
    """a, b, ok: exact similarity of the whole texts of candidate pairs. Rows come by a and salt: first the text of a (b is null), then those of its partners."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_name, own = None, None
        for batch in batches:
            firsts, seconds, ok = [], [], []
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                names, partners = part.column("a").to_pylist(), part.column("b").to_pylist()
                for a, b, w in zip(names, partners, all_words(part.column("text").to_pylist()), strict=True):
                    if b is None:
                        own_name, own = a, shingle_set(w, width)
                        continue
                    if a != own_name:
                        raise RuntimeError("a pair has met no first text")
                    firsts.append(a)
                    seconds.append(b)
                    ok.append(linked(own, shingle_set(w, width), percent))
            yield pa.record_batch([pa.array(firsts, pa.int64()), pa.array(seconds, pa.int64()), pa.array(ok, pa.bool_())], ["a", "b", "ok"])
    return run


#: Rows of the bit table that lets a scan pass by documents no candidate names: fixed, 64 bits each.
BIT_ROWS = 1 << 17


def row_hash(id_col, text) -> Column:
    """Names a row by its id and text; rows that repeat both share it."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text))


def bit_table(named: DataFrame) -> DataFrame:
    """word, bits: at most ``BIT_ROWS`` rows whatever the input, with a bit set for every row hash in column row."""
    word, bit = bit_place(F.col("row"))
    return named.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))


def bit_place(row: Column) -> tuple[Column, Column]:
    return F.floor(F.pmod(row, F.lit(BIT_ROWS * 64)) / 64), F.pmod(row, F.lit(64)).cast("int")


def maybe_named(rows: DataFrame, named: DataFrame, wanted: bool = True) -> DataFrame:
    """Rows (column row) that ``named`` may hold, or those it does not hold for sure; no row is shuffled."""
    word, bit = bit_place(F.col("row"))
    joined = rows.withColumn("word", word).join(F.broadcast(bit_table(named)), "word", "left")
    hit = F.getbit(F.coalesce("bits", F.lit(0).cast("long")), bit) == 1
    return joined.filter(hit if wanted else ~hit).drop("word", "bits")


def named_texts(rows: DataFrame, base: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text of one row for each node. A bit table of fixed size keeps most other texts out of the shuffle; the join after it is exact."""
    ids = stored(base.join(nodes, "node").groupBy("node").agg(F.min("row").alias("row")), "named")
    return maybe_named(rows, ids).select("row", "text").join(ids, "row").groupBy("node").agg(F.min("text").alias("text"))


#: Tasks over which the partners of one set are dealt.
SALTS = 16


def verified(pairs: DataFrame, rows: DataFrame, base: DataFrame, width: int, percent: int) -> DataFrame:
    """a, b, ok of stored pairs of nodes, from the whole texts. A row holds one text; that of a set with many partners goes once to each of a few salts."""
    texts = stored(named_texts(rows, base, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "pair-texts")
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    partners = pairs.join(texts.select(F.col("node").alias("b"), "text"), "b").select("a", "salt", "b", "text")
    own = pairs.select("a", "salt").distinct().join(texts.select(F.col("node").alias("a"), "text"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    both = own.unionByName(partners).repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
    return stored(both.select("a", "b", "text").mapInArrow(checked(width, percent), "a long, b long, ok boolean"), "verified")


def not_ruled_out(percent: int):
    """a, b of the pairs that wide sketches leave possible; a pair without them stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = [x is None or y is None or within(np.frombuffer(x, "u1"), np.frombuffer(y, "u1"), total, percent)
                     for x, y, total in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "total")), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(stays, pa.bool_()))
    return run


def close(pairs: DataFrame, base: DataFrame, percent: int) -> DataFrame:
    """Stored pairs of nodes that wide sketches leave possible: a few hundred bytes of a long text move for a pair, where the whole text would."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wides = stored(base.filter("wide is not null").join(named, "node").groupBy("node").agg(F.min("wide").alias("wide"), F.min("n_shingles").alias("n")), "wides")
    side = lambda c, w: wides.select(F.col("node").alias(c), F.col("wide").alias(w), F.col("n").alias(f"n_{c}"))
    both = pairs.join(side("a", "x"), "a", "left").join(side("b", "y"), "b", "left").select("a", "b", "x", "y", (F.col("n_a") + F.col("n_b")).alias("total"))
    return stored(both.mapInArrow(not_ruled_out(percent), "a long, b long"), "close")


def apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs that no component holds together yet."""
    side = lambda c: comps.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    return pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").filter(
        F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def shared_keys(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """key, node, low, high of every key that more than one set has; low and high are its least and greatest set.

    One exchange by key serves the aggregate and the join, so the index rows are made and moved once. A key's rows stream through one
    task, sorted and spillable, against a single row; nothing holds them together.
    """
    keyed = rows.select("text").mapInArrow(indexed(width, percent), "key long, node long").repartition("key")
    shared = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high")
    return stored(keyed.join(shared, "key").distinct(), "met")


#: Turns in which every set is compared with one more partner only.
PICKS = 4
#: Sets of a key up to which its pairs are compared one by one, and the part of such keys that goes first: sets of one text share many keys.
FEW, SHARE = 512, 16


def with_component(rows: DataFrame, comps: DataFrame) -> DataFrame:
    return rows.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))


def still_open(met: DataFrame, comps: DataFrame) -> DataFrame:
    """key, node, component of the keys whose sets are not all in one component."""
    now = with_component(met.select("key", "node"), comps)
    return now.join(now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key"), "key", "left_semi")


def met_pairs(asking: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """a, b: sets of one key in different components; sizes and sketches are part of the join's condition, so pairs that cannot link are never made."""
    one, two = asking.alias("one"), held.alias("two")
    smaller = F.struct("one.n", "one.node") < F.struct("two.n", "two.node")
    rest = one.join(two, (F.col("one.key") == F.col("two.key")) & smaller & (F.col("one.component") != F.col("two.component")) & may_link("one", "two", percent))
    return rest.select(F.least("one.node", "two.node").alias("a"), F.greatest("one.node", "two.node").alias("b")).distinct()


def jaccard_components(docs: DataFrame, text: str = "text", id_col: str = "doc_id", width: int = 4, percent: int = 85) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links, its own included), component (equal for linked rows, null
    without shingles), row (a hash of id and text).

    Two rows link when their sets' Jaccard similarity is ``percent`` or more. Sets of a key are first paired with the key's least and greatest
    set; a few turns verify one such partner for every set, the next all of those that still stand apart. Then keys of few sets are compared
    pair by pair across components, and the sets of crowded keys are indexed again with twice the segments that a link needs and look up
    their rarest ones. So a group of copies costs about as many verifications as it has members, and no link between components is left out. Null and empty texts have no
    shingles and stand alone under their own id; a null id is no smallest id unless its group has no other; repeated rows and ids are
    rows like others; other columns are not read; no rows give no rows.
    """
    with narrow_batches(docs.sparkSession):
        return _components(docs, text, id_col, width, percent)


def _components(docs: DataFrame, text: str, id_col: str, width: int, percent: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).withColumn("row", row_hash("doc_id", "text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    base = stored(rows.mapInArrow(measured(width), f"doc_id {kind}, row long, n_shingles long, node long, " + ", ".join(f"{c} long" for c in PARTS) + ", wide binary"), "sets")
    nodes = stored(base.filter("node is not null").groupBy("node").agg(F.min("n_shingles").alias("n"), *[F.min(c).alias(c) for c in PARTS]), "nodes")
    met = shared_keys(rows, width, percent)
    none = docs.sparkSession.createDataFrame([], "a long, b long")
    state = {"known": none, "comps": none.select(F.col("a").alias("node"), F.col("b").alias("component"))}

    def settle(pairs: DataFrame, many: bool = True) -> None:
        """Verifies pairs and joins the components of those that link; where a set has many partners, wide sketches rule out first."""
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            return
        state["known"] = state["known"].unionByName(pairs)
        got = verified(close(pairs, base, percent) if many else pairs, rows, base, width, percent)
        state["comps"] = merged(state["comps"], got.filter("ok").select("a", "b"))

    # stars: every set of a key with the key's least and with its greatest set, where sizes and sketches allow a link
    ends = F.explode(F.array("low", "high")).alias("end")
    one, two = nodes.alias("one"), nodes.alias("two")
    stars = met.select("node", ends).filter("node <> end").select(F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b")).distinct()
    stars = stored(stars.join(one, F.col("a") == F.col("one.node")).join(two, F.col("b") == F.col("two.node")).filter(may_link("one", "two", percent)).select("a", "b"), "stars")
    for _ in range(PICKS):  # one partner for a set and turn: most of a group is together before most of its pairs were ever compared
        left = apart(stars, state["comps"]).join(state["known"], ["a", "b"], "left_anti")
        settle(left.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), many=False)
    settle(apart(stars, state["comps"]).join(state["known"], ["a", "b"], "left_anti"))
    # what is left: sets of one key in different components. Keys of few sets are compared pair by pair, a share of the keys before the others;
    # the sets of other keys are indexed again and look up their rarest segments only
    open_rows = still_open(met, state["comps"])
    few = open_rows.groupBy("key").agg(F.count("*").alias("members")).filter(F.col("members") <= FEW).select("key")
    crowded = stored(open_rows.join(few, "key", "left_anti").select("node").distinct(), "crowded")
    for share in (SHARE, 1):
        part = still_open(met.filter(F.pmod("key", F.lit(share)) == 0).join(few, "key", "left_semi"), state["comps"]).join(nodes, "node")
        settle(met_pairs(part, part, percent).join(state["known"], ["a", "b"], "left_anti"))
    if not crowded.isEmpty():
        texts = named_texts(rows, base, crowded)
        again = stored(texts.mapInArrow(spared(width, percent), "key long, node long, need int"), "again")
        shared = again.groupBy("key").agg(F.count("*").alias("members"))
        rarest = F.row_number().over(Window.partitionBy("node").orderBy("members", "key"))  # a set's keys of one scheme
        asked = again.filter("need is not null").join(shared, "key").withColumn("place", rarest).filter("place <= need and members > 1").select("key", "node")
        asked = stored(with_component(asked, state["comps"]).join(nodes, "node"), "asked")
        held = with_component(again.select("key", "node").join(asked.select("key").distinct(), "key", "left_semi"), state["comps"]).join(nodes, "node")
        settle(met_pairs(asked, held, percent).join(state["known"], ["a", "b"], "left_anti"))
    comps = state["comps"]
    placed = base.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = stored(placed.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("least")), "least")
    return placed.join(least, "component", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "component", "row")


def one_of_each(docs: DataFrame, text: str = "text", id_col: str = "doc_id", width: int = 5, percent: int = 80) -> DataFrame:
    """All columns of docs; of every group of linked documents only that with the smallest id stays. Documents without a shingle stay.

    Only rows that may belong to a group of two or more are shuffled. Rows that repeat id and text are one group and one of them stays.
    """
    found = stored(jaccard_components(docs, text, id_col, width, percent).filter("component is not null").select("doc_id", "component", "row"), "found")
    groups = found.groupBy("component").agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")).alias("x")).filter("n > 1")
    touched = stored(found.join(groups.select("component", F.col("x.row").alias("first")), "component").select("row", (F.col("row") == F.col("first")).alias("stays")).distinct(), "touched")
    rows = docs.select(F.struct("*").alias("doc"), row_hash(id_col, text).alias("row"))
    near = maybe_named(rows, touched).join(touched, "row", "left")
    stay = near.filter("stays is null").select("doc").unionByName(near.filter("stays").dropDuplicates(["row"]).select("doc"))
    return maybe_named(rows, touched, wanted=False).select("doc").unionByName(stay).select("doc.*")


@query("op10_partition_jaccard")
def op10_partition_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("component", "row")
