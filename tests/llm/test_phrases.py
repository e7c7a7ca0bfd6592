"""Operator 12 against a plain count of every phrase."""

import random
import re
from collections import Counter

from attestra.llm import phrases as op

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, minimum, covered, top):
    counts = {}
    for text, lang in rows:
        c = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(AZ)):
            w = re.findall("[^ \t]+", piece)
            c.update(tuple(w[i:i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        n = sum(v for g, v in c.items() if len(g) == 1)
        found = {g: a for g, a in c.items() if len(g) > 1 and a >= minimum}
        gone = {q[i:i + m] for q, f in found.items() for m in range(2, len(q)) for i in range(len(q) - m + 1) if 100 * f >= covered * found[q[i:i + m]]}
        scored = []
        for g, a in found.items():
            if g not in gone:
                score, _, left, right = min((2000000 * a // (c[g[:k]] + c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -score) for i, (score, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def corpus(seed):
    rnd = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = []
    for i in range(150):
        words = [rnd.choice(["the", "of", "A", "b", "cc", "é", "日本", "d\x00d"] + [f"r{rnd.randrange(200)}"]) for _ in range(rnd.randrange(60))]
        text = "".join(w + rnd.choice([" ", " ", " ", " \t ", ", ", ".\n", "!"]) for w in words)
        rows.append((text + (passage if i % 9 == 0 else "") + (" " + " ".join(passage.split()[5:30]) if i % 4 == 0 else ""), rnd.choice(["en", "en", "xx", None])))
    return rows + [(None, "en"), ("", None), (" . , ", "en"), ("same words again " * 300, "fr"), ("same words again " * 300, "fr"), ("a a a a a a a a", "aa"), ("solo", "one")]


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_equals_the_plain_count(spark):
    for seed, minimum, covered, top in [(1, 3, 80, 1000), (2, 2, 50, 40), (3, 30, 80, 2000)]:
        rows = corpus(seed)
        docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
        assert rows_of(op.phrases(docs, minimum=minimum, covered=covered, top=top)) == plain(rows, minimum, covered, top)


def test_full_bit_table_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(op, "frequent_bits", lambda rows, minimum: b"\xff" * (8 * op.BIT_WORDS))
    rows = corpus(4)
    assert rows_of(op.phrases(spark.createDataFrame(rows, "text string, lang string"), minimum=3)) == plain(rows, 3, 80, 2000)


def test_parts_of_a_task_add_up(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = corpus(5)
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)

    class Shared:
        value = b"\xff" * (8 * op.BIT_WORDS)

    totals = docs.select("lang", "text").mapInArrow(op.longest_grams(Shared), "lang string, k int, gram string, n long")
    words = sum(len(re.findall(r"[^ \t.,;:!?\n\x0b\x0c\r]+", t or "")) for t, _ in rows)
    assert totals.agg(F.sum("n")).first()[0] == words  # every place begins one gram


def test_unary_paths(spark):
    edges = [("en", f"w{i} w{i + 1} w{i + 2} w{i + 3}", 7) for i in range(20)] + [("en", "x y z w0", 9), ("fr", "w0 w1 w2 w3", 7)]
    nodes = {(lang, part): n for lang, g, n in edges for part in (" ".join(g.split()[:3]), " ".join(g.split()[1:]))}
    nodes[("en", "w9 w10 w11")] = 8  # one more end here: the path is cut
    got = op.compacted(spark.createDataFrame(edges, "lang string, gram string, n long"), spark.createDataFrame([(*k, n) for k, n in nodes.items()], "lang string, gram string, n long"))
    assert sorted((r.lang, " ".join(r.words), r.n) for r in got.collect()) == sorted([
        ("en", " ".join(f"w{i}" for i in range(12)), 7), ("en", " ".join(f"w{i}" for i in range(9, 23)), 7), ("en", "x y z w0", 9), ("fr", "w0 w1 w2 w3", 7)])


def test_odd_rows_and_no_rows(odd, odd_rows, none):
    rows = [(r[1], r[2]) for r in odd_rows]
    assert rows_of(op.phrases(odd, minimum=2)) == plain(rows, 2, 80, 2000)
    assert op.phrases(none).count() == 0


def test_equals_sql_on_whole_documents(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.execute(f"select lang, rank, phrase, a, l, r, n, score from ({op.SQL})").fetchall())
    assert rows_of(op.op12_de_bruijn_phrases(spark, sf)) == want
