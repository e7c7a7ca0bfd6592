"""Operator 13 against scores of every document."""

import math
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from attestra.llm import search as op

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(AZ))


def plain(docs, items, top=10):
    words = [(i, terms_of(t)) for i, t in docs]
    n_docs, total = sum(1 for _, w in words if w), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in sorted(set(items), key=str):
        wanted, scored = Counter(terms_of(text)), []
        for i, w in words:
            tf, score = Counter(w), 0
            for t, repeats in wanted.items():
                if tf[t]:
                    m = 25 + 75 * len(w) * n_docs // total
                    score += repeats * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    pick = lambda: rnd.choice(["the", "of", "The", "naïve", "日本"] + [f"t{int(rnd.paretovariate(0.6)) % 3000}" for _ in range(3)])
    docs = [(i, " ".join(pick() + rnd.choice(["", ",", "-x", "_", "\x00"]) for _ in range(rnd.choice([3, 20, 20, 90])))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(30)] + [(None, docs[3][1]), (None, None), (5000, None), (5001, ""), (5002, " .,; "), (7, "twice of one id"), (6000, "the of " * 4000)]
    items = [(i, " ".join(terms_of(rnd.choice(docs[:n])[1])[:rnd.randrange(1, 40)])) for i in range(25)]
    return docs, items + [(100, None), (101, ""), (102, "nowhere known"), (0, items[0][1]), (None, "the of t1"), (103, docs[7][1]), (104, "the the the of")]


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_equals_the_plain_scores(spark):
    for seed, n, parts in [(1, 300, 4), (2, 60, 1)]:
        docs, items = corpus(seed, n)
        got = op.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts), spark.createDataFrame(items, "item_id long, text string"))
        assert rows_of(got) == plain(docs, items)


def test_small_blocks_and_windows(monkeypatch):
    """Blocks, windows, short lists and carried floors of every kind lose no document."""
    docs, items = corpus(3, 400)
    docs = [(i if i is not None else 9000 + k, t) for k, (i, t) in enumerate(docs)]
    words = [terms_of(t) for _, t in docs]
    n_docs, total, df = sum(1 for w in words if w), sum(map(len, words)), Counter(t for w in words for t in set(w))
    batch = pa.record_batch([pa.array([i for i, _ in docs]), pa.array([t for _, t in docs])], ["doc_id", "text"])
    want = {}
    for item, rank, doc_id, score in plain(docs, [(i, t) for i, t in items if i is not None]):
        want.setdefault(item, set()).add((doc_id, score))
    for window, short, block in [(16, 16, 100), (64, 1, 1000), (64, 10**9, 37), (8, 4, 1000)]:
        monkeypatch.setattr(op, "WINDOW", window)
        monkeypatch.setattr(op, "SHORT", short)
        monkeypatch.setattr(op, "BLOCK_DOCS", block)
        shared = SimpleNamespace(value=b"\xff" * (8 * op.BIT_WORDS))
        blocks = [op.Block(row, n_docs, total) for out in op.indexed(shared)(iter([batch])) for row in out.to_pylist()]
        for item, text in items:
            if item is None or not terms_of(text):
                continue
            count = Counter(terms_of(text))
            hashes = [int(np.uint64(next(op.term_hashes([t]))[0]).view("i8")) for t in count]
            weights = [r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t, r in count.items()]
            found, floor = [], 0
            for b in blocks:
                best = b.search(hashes, weights, 10, floor)
                floor = max(floor, best.floor)
                found += [(-s, b.doc_ids[p]) for s, p in zip(best.scores.tolist(), best.places.tolist(), strict=True)]
            assert {(d, -s) for s, d in sorted(found)[:10]} == want.get(item, set()), (item, window)


def test_documents_are_passed_over():
    """Once the tenth best score is beyond what the common terms give, their documents are not scored."""
    lengths = [10] * 10_000
    block = op.Block({"doc_ids": list(range(10_000)), "lengths": lengths, "terms": [1, 2], "dfs": [20, 10_000], "places": op.pack(np.concatenate([np.arange(20), np.arange(10_000)]).astype("<u4")),
                      "occurs": op.pack(np.ones(10_020, "<u4"))}, 10_000, 100_000)
    seen = []
    add = op.Best.add
    op.Best.add = lambda self, s, p: (seen.append(len(p)), add(self, s, p))[1]
    try:
        best = block.search([1, 2], [6000, 1], 10, 0)
    finally:
        op.Best.add = add
    assert best.places.tolist() == list(range(10)) and sum(seen) == 20


def test_string_ids_odd_rows_and_no_rows(spark, odd, odd_rows, none):
    items = spark.createDataFrame([(1, odd_rows[5][1]), (2, "One text"), (3, "é 日本")], "item_id long, text string")
    assert rows_of(op.search(odd, items)) == plain([(r[0], r[1]) for r in odd_rows], [(r.item_id, r.text) for r in items.collect()])
    assert op.search(odd.withColumn("doc_id", odd.doc_id.cast("string")), items).count() > 0
    assert op.search(none, items).count() == 0 and op.search(odd, items.limit(0)).count() == 0


def test_equals_sql_on_whole_documents(spark, sf):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    want = sorted(con.execute(f"select item_id, rank, doc_id, score from ({op.SQL})").fetchall(), key=str)
    assert rows_of(op.op13_hybrid_search(spark, sf)) == want
