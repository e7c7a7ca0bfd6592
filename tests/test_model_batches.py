"""Article routes and batched similarity scores against plain walks, with odd rows and on empty tables."""

import json
import re

from pyspark.sql import functions as F

from attestra.operators import model as M

DOCS = [(1, "full"), (2, "<!-- a\nb --><!--x--> head \n---\n body " + "y" * 7000), (3, None), (4, "  "), (5, "same"), (5, "same"), (None, "no key")]
CHUNKS = [(1, 2, " second ", "abstract"), (1, 1, "first\n", "abstract"), (1, 0, "other", "method"), (2, 1, "  ", "abstract"), (4, 1, None, "abstract"), (9, 1, "left out", "abstract"), (None, 1, "of nobody", "abstract")]
BODY = "<!-- a\nb --> head \n body " + "y" * 7000
TEXTS = {1: "first\n\nsecond", 2: BODY[:6000].strip(), 3: "", 4: "", 5: "same", None: "no key"}


def test_route_text_and_turns(spark):
    docs = spark.createDataFrame(DOCS, "doc_id int, text string").repartition(3)
    chunks = spark.createDataFrame(CHUNKS, "doc_id int, chunk_id int, text string, semantic_category string").repartition(3)
    got = [(r.doc_id, r.route_text) for r in M.route_text(docs, chunks, "doc_id").collect()]
    key = lambda x: str(x)
    assert sorted(got, key=key) == sorted([(i, TEXTS[i]) for i, _ in DOCS], key=key)
    answers = {"first\n\nsecond": '{"article_type": "PROTOCOL"}', "same": "a theoretical_narrative", "no key": '{"article_type": "theoretical_narrative"} protocol', "": "{protocol}"}
    routed = M.route_articles(docs, chunks, lambda prompts: [answers.get(p.split("document:\n\n", 1)[1], "unknown") for p in prompts])
    assert sorted([(r.doc_id, r.article_type) for r in routed.collect()], key=key) == sorted(
        [(1, "protocol"), (2, "empirical"), (3, "empirical"), (4, "empirical"), (5, "theoretical_narrative"), (5, "theoretical_narrative"), (None, "theoretical_narrative")], key=key)
    assert set(routed.columns) == {"doc_id", "text", "article_type"}
    assert M.route_articles(docs.filter("false"), chunks, lambda prompts: ["protocol"] * len(prompts)).count() == 0


def test_route_of(spark):
    cases = {None: None, "": None, "protocol": "protocol", "EMPIRICAL or protocol": "empirical", '{"article_type": "poem"} protocol': "protocol", '{"a": 1}': None, "{bad} protocol": None, '{"article_type": " Empirical "}': "empirical"}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "a string, want string").withColumn("got", M.route_of("a"))
    assert all(r.got == r.want for r in rows.collect())


WORKS = [("a", i, None if i % 3 == 0 else f"T{i}", None if i % 4 == 0 else 2000 + i, (None, "s", "long é " * 80)[i % 3]) for i in range(7)] + [("b", 1, "B", 2001, ""), (None, 3, "lost", None, None)]
PAPERS = [("a", "own abstract"), ("c", "no works")]


def plain_prompts(size):
    out, groups = {}, {}
    for w in sorted(WORKS, key=lambda w: w[1]):
        groups.setdefault(w[0], []).append(w)
    for paper, works in groups.items():
        for at in range(0, len(works), size):
            lines = ["PAPER ABSTRACT UNDER REVIEW:", dict(PAPERS).get(paper, ""), "", "RELATED WORKS TO SCORE:"]
            for n, (_, _, title, year, text) in enumerate(works[at:at + size], at + 1):
                text = text[:400].rstrip() + " ..." if text and len(text) > 400 else text
                lines.append(f"\n[{n}] {title or '(no title)'} ({year or 'n.d.'})\n   Abstract: {text or '(not available)'}")
            out["\n".join(lines)] = (paper, at // size)
    return out


def test_batches_of_works(spark):
    works = spark.createDataFrame(WORKS, "paper string, work_id int, title string, year int, abstract string").repartition(3)
    papers = spark.createDataFrame(PAPERS, "paper string, abstract string")
    prompts = plain_prompts(3)
    answers = {("a", 0): [(1, 0.456), (2, "2"), (3, 0), (4, 0.9), (0, 1)], ("a", 1): [(4, -3), (5, "x"), ("6", 0.5), (6, 0.75), (None, 1)], ("a", 2): [(1, 0.3), (7, None), (99, 1)], ("b", 0): None}

    def fn(batch):
        out = []
        for p in batch:
            rows = answers.get(prompts[p])  # an unknown prompt fails the batch and so leaves defaults
            out.append("sorry" if rows is None else "Here: " + json.dumps([{"index": i, "similarity_score": s} for i, s in rows]))
        return out

    got = {(r.paper, r.work_id): (r.work_no, r.similarity) for r in M.score_work_batches(works, papers, fn, "paper", "work_id", size=3, retries=1).collect()}
    want = {1: 0.3, 2: 1.0, 3: 0.1, 4: 0.0, 5: 0.1, 6: 0.75, 7: 0.1}
    assert {k: v for k, v in got.items() if k[0] == "a"} == {("a", i): (i + 1, want[i + 1]) for i in range(7)}
    assert got[("b", 1)] == (1, 0.1) and got[(None, 3)] == (1, 0.1) and len(got) == len(WORKS)
    seen = spark.createDataFrame([(p,) for p in prompts], "p string").filter(F.col("p").contains("(not available)")).count()
    assert seen and all(re.search(r"\[1\]|\[4\]|\[7\]", p) for p in prompts)
    assert M.score_work_batches(works.filter("false"), papers, fn, "paper", "work_id").count() == 0
