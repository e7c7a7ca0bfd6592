"""Similarity measures over token arrays and count maps."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Mapping, Sequence
from heapq import heappop, heappush

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions.columns import as_col
from attestra.functions.text import word_places


def jaccard(a, b) -> Column:
    a, b = as_col(a), as_col(b)
    both = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / both).otherwise(0.0)


def overlap(a, b) -> Column:
    """Shared tokens over the smaller set."""
    a, b = F.array_distinct(as_col(a)), F.array_distinct(as_col(b))
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(0.0)


def _products(a: Column, b: Column) -> Column:
    """Sum of the products of two count maps."""
    both = F.map_values(F.map_zip_with(a, b, lambda k, x, y: x * y))
    return F.aggregate(both, F.lit(0).cast("long"), lambda acc, v: acc + F.coalesce(v, F.lit(0)))


def token_counts(df: DataFrame, key: str, tokens) -> DataFrame:
    """Count vectors: one row per key with counts, a map token -> number. Rows of one key add up; keys without tokens have an empty map.

    Tokens are counted within their rows, so what moves is one map a row and not a row a token.
    """
    own = df.select(key, F.transform_values(word_places(as_col(tokens)), lambda k, v: F.size(v).cast("long")).alias("counts"))
    add = lambda a, b: F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    all_maps = own.groupBy(key).agg(F.collect_list("counts").alias("_all"))
    empty = F.create_map().cast("map<string,bigint>")
    return all_maps.select(key, F.when(F.size("_all") == 1, F.get("_all", F.lit(0))).otherwise(F.aggregate("_all", empty, add)).alias("counts"))


def cosine_counts(pairs: DataFrame, counts: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """Cosine of the count vectors (key, counts) of given pairs; 0 where a side has no tokens."""
    side = lambda k, name: counts.select(F.col(key).alias(k), F.col("counts").alias(name))
    both = pairs.join(side(left, "_a"), left, "left").join(side(right, "_b"), right, "left")
    norm = lambda c: F.sqrt(F.aggregate(F.map_values(c), F.lit(0).cast("long"), lambda acc, v: acc + v * v))
    cosine = F.try_divide(_products(F.col("_a"), F.col("_b")), norm("_a") * norm("_b"))
    return both.select(*pairs.columns, F.coalesce(cosine, F.lit(0.0)).alias("cosine"))


def cosine_vectors(a, b) -> Column:
    a, b = as_col(a), as_col(b)
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def places(text: str) -> dict[str, list[int]]:
    """The places of every character."""
    out: dict[str, list[int]] = {}
    for i, c in enumerate(text):
        out.setdefault(c, []).append(i)
    return out


# Texts from this length on have popular characters, which start no matching block; characters of the grams that are sketched, in shorter texts and in those.
POPULAR_FROM = 200
GRAMS = (2, 5)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def gram_sketch(text: str, gram: int) -> tuple[int, bytes]:
    """How many characters of the text may start a matching block, and a bit for every gram with its running number among its like.

    A bit that another sketch lacks stands for a gram that its text lacks, or has less often. About four bits a character, a power of two up to 2 ** 19; a
    longer sketch is brought to the length of a shorter one by joining its parts.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    counts = np.unique(points, return_counts=True)[1]
    rare = int(counts[counts <= len(text) // 100 + 1].sum()) if len(text) >= POPULAR_FROM else len(text)
    n = max(len(text) - gram + 1, 0)
    codes = np.zeros(n, np.uint64)
    for k in range(gram):
        codes = codes * _MIX + points[k:k + n]
        codes ^= codes >> np.uint64(29)
    codes.sort()
    place = np.arange(n)
    if n:
        place -= np.maximum.accumulate(np.where(np.concatenate([[True], codes[1:] != codes[:-1]]), place, 0))
    codes += place.astype(np.uint64) * _MIX
    for _ in range(2):
        codes = (codes ^ (codes >> np.uint64(32))) * _MIX
    bits = 1 << min(max((4 * len(text) - 1).bit_length(), 8), 19)
    flags = np.zeros(bits, np.uint8)
    flags[(codes >> np.uint64(32)) & np.uint64(bits - 1)] = 1
    return rare, np.packbits(flags, bitorder="little").tobytes()


def seq_reaches(a: str, at_a: Mapping[str, Sequence[int]], b: str, at_b: Mapping[str, Sequence[int]], threshold: float) -> bool:
    """Whether ``SequenceMatcher(None, a, b).ratio()`` reaches the threshold, by the same blocks; it ends once the parts still open cannot reach it.

    As there, characters that make up over a hundredth of a long ``b`` start no block; only the others' places are walked. The longest open parts go first.
    """
    total, popular = len(a) + len(b), len(b) // 100 + 1 if len(b) >= POPULAR_FROM else len(b)
    if not total:
        return threshold <= 1.0
    starts = sorted((i, c) for c, found in at_a.items() if 0 < len(at_b.get(c, ())) <= popular for i in found)
    matched, left = 0, min(len(a), len(b))
    todo = [(-left, 0, len(a), 0, len(b))]
    while todo and 2.0 * (matched + left) / total >= threshold:
        less, alo, ahi, blo, bhi = heappop(todo)
        left += less
        x, y, size, runs, last = alo, blo, 0, {}, -2
        for n in range(bisect_left(starts, (alo,)), len(starts)):
            i, c = starts[n]
            if i >= ahi:
                break
            found, follows, last = at_b[c], i == last + 1, i
            before, runs = runs, {}
            m = bisect_left(found, blo)
            if not size and m < len(found) and found[m] < bhi:
                x, y, size = i, found[m], 1
            # a run of two or more needs a starting character right before: all other places are passed by
            for m in range(m, len(found)) if follows else ():
                j = found[m]
                if j >= bhi:
                    break
                if j > blo and b[j - 1] == a[i - 1]:
                    k = runs[j] = before.get(j - 1, 1) + 1
                    if k > size:
                        x, y, size = i - k + 1, j - k + 1, k
        while x > alo and y > blo and a[x - 1] == b[y - 1]:
            x, y, size = x - 1, y - 1, size + 1
        while x + size < ahi and y + size < bhi and a[x + size] == b[y + size]:
            size += 1
        if size:
            matched += size
            for part in ((alo, x, blo, y), (x + size, ahi, y + size, bhi)):
                if part[0] < part[1] and part[2] < part[3]:
                    longest = min(part[1] - part[0], part[3] - part[2])
                    heappush(todo, (-longest, *part))
                    left += longest
    return 2.0 * (matched + left) / total >= threshold
