"""Queries against their SQL on small tables made for cases that the driver tables do not show at their least size."""

import difflib
import random
import time

import duckdb
import pandas as pd

from pyspark.sql import functions as F

from attestra.catalog import ORACLES, QUERIES
from attestra.functions.rules import plain_json
from attestra.functions.similarity import gram_sketch
from attestra.functions.text import norm_name
from attestra.operators import dedupe as D
from attestra.operators.dedupe import _near_in_cell
from attestra.operators.joins import match_token_sets
from attestra.sources import records as R
from tools_check import digest


def same(spark, at, name, tables):
    con = duckdb.connect()
    for t, sql in tables.items():
        duckdb.sql(sql).write_parquet(f"{at}/{t}.parquet")
        con.execute(f"create view {t} as select * from '{at}/{t}.parquet'")
    rel = con.execute(ORACLES[name])
    df = QUERIES[name](spark, str(at))
    return digest(df.columns, [tuple(r) for r in df.collect()]) == digest([d[0] for d in rel.description], rel.fetchall())


def test_scores_of_papers_with_many_works(spark, tmp_path):
    assert same(spark, tmp_path, "score_work_batches", {
        "embeddings": "SELECT range AS vec_id, [0.5] AS embedding FROM range(9000)",
        "documents": "SELECT range AS doc_id, 'text ' || range AS text, 'en' AS lang, 'a' AS source, 1 AS n_chars FROM range(40)"})


def test_markdown_goes_many_documents_to_a_file(spark, tmp_path):
    texts = ["---\na: 1\n---\nbody", " \n", None, "é\r\nx", "tail\n"]
    docs = spark.createDataFrame([(f"d{i}" if i else "site.org", t) for i, t in enumerate(texts)], "stem string, text string").coalesce(1)
    at = str(tmp_path / "packed")
    R.pack_markdown(docs, "stem", "text", at)
    got = {r.stem: (r.domain, r.text) for r in R.read_packed(spark, at).collect()}
    assert got == {"site.org": ("site.org", "body"), "d1": ("", " \n"), "d3": ("", "é\r\nx"), "d4": ("", "tail\n")}
    assert spark.read.parquet(at).select(F.input_file_name()).distinct().count() == 1


def test_claims_near_the_abstract_match_the_walk(spark):
    rnd, rows = random.Random(4), []
    for i in range(160):
        text = "".join(rnd.choice("abcde fghij klmno.") for _ in range(rnd.choice([3, 30, 190, 260, 900])))
        rows.append((i % 3, 2 * i, text, "abstract", "x"))
        near = list(text)
        for _ in range(len(text) * (i % 5) // 16):
            near[rnd.randrange(len(near))] = rnd.choice(["", "z", "ab"])
        rows.append((i % 3, 2 * i + 1, "".join(near), "other", "Key Messages"))
    flat = {r[1]: " ".join(r[2].lower().split()) for r in rows}
    texts = {g: [flat[r[1]] for r in rows if r[0] == g and r[3] == "abstract"] for g in range(3)}
    want = sorted(i for g, i, t, c, _ in rows if c == "other" and t and any(difflib.SequenceMatcher(None, flat[i], x).ratio() >= 0.85 for x in texts[g]))
    df = spark.createDataFrame(rows, "g int, claim_id int, claim string, semantic_category string, section_heading string")
    for size in (200, 7):
        assert sorted(r.claim_id for r in D.dup_of_abstract(df, ["g"], size=size).collect()) == want
    assert 10 < len(want) < 150


def test_lines_of_common_words_are_not_counted_against_every_cluster():
    rnd, common = random.Random(2), [f"w{i}" for i in range(400)]
    sets = [rnd.sample(common, 200) for _ in range(1500)]
    new = pd.DataFrame({"item": range(1500), "cluster": range(1, 1501), "tokens": [dict.fromkeys(s, 1) for s in sets], "size": 0})
    start = time.process_time()
    out = D._best_jaccard(0.55)({"g": 1}, new.iloc[:0], new)
    assert (out.kind == "line").sum() == 1500 and time.process_time() - start < 4


def test_token_sets_that_many_entries_share(spark):
    """Forty thousand queries and entries of one set: 1.6 billion pairs, were they joined."""
    many = spark.range(40000)
    names = lambda df, key: df.select(F.col("id").alias(key), F.when(F.col("id") < 39990, F.array(F.lit("A "), F.lit("b"))).when(F.col("id") < 39995, F.array(F.lit(f"{key} x"), F.lit("B"))).otherwise(
        F.array(F.lit(key), F.col("id").cast("string"))).alias("names"))
    start = time.time()
    got = {r.q: (r.matches, r.e, r.status, r.hints) for r in match_token_sets(names(many, "q"), names(many, "e"), "q", "e").collect()}
    assert len(got) == 40000 and all(got[i][:3] == (39990, None, "ambiguous") for i in range(39990))
    assert all(got[i] == (0, None, "none", list(range(8))) for i in range(39990, 39995)) and all(got[i][:3] == (0, None, "none") for i in range(39995, 40000))
    assert time.time() - start < 40


def test_rule_texts_go_row_by_row(spark):
    df = spark.createDataFrame([('{"b": {"meta": 1, "z": "é"}, "a": [1, {"query": 2}]}',), (None,)], "j string").select(plain_json("j").alias("t"))
    assert [r.t for r in df.collect()] == ['{"a": [1, {}], "b": {"z": "é"}}', "null"]
    assert "ArrowEvalPython" not in df._jdf.queryExecution().toString()


def test_names_go_row_by_row(spark):
    df = spark.createDataFrame([("  ﬁsetin \n A",), (None,), ("x",)], "n string").select(norm_name("n").alias("t"))
    assert [r.t for r in df.collect()] == ["fisetin a", "", "x"]
    assert "ArrowEvalPython" not in df._jdf.queryExecution().toString()


def test_snippets_of_odd_texts(spark, tmp_path):
    texts = ["NULL", "''", "'   '", "chr(160) || ' first'", "'last ' || chr(12288)", "repeat('a', 59) || chr(160) || 'tail'", "repeat(' ', 70) || 'late'", "chr(10)", "'plain text'"]
    rows = " UNION ALL ".join(f"SELECT (range * {len(texts)} + {i})::BIGINT AS doc_id, {t} AS text, 'en' AS lang, 'src' || range % 3 AS source, 1 AS n_chars FROM range(-9, 36)" for i, t in enumerate(texts))
    for name in ("snippets", "evidence_units"):
        assert same(spark, tmp_path, name, {"documents": f"{rows} UNION ALL SELECT NULL, 'no id', 'en', 'a', 1"})


def test_sketches_of_grams_rule_out_no_pair_that_reaches():
    """And of long unlike texts of the same syllables all but none is left to a walk."""
    rnd, kept = random.Random(9), 0
    frame = lambda i, t, g: pd.DataFrame([(i, len(t), *gram_sketch(t, g))], columns=["_tid", "_n", "_rare", "_sketch"])
    for _ in range(1200):
        letters = rnd.choice(["ab", "abcdefghijklmnopqrstuvwxyz   ttt", "e" * 30 + "t" * 20 + " zqxjk"])
        a = "".join(rnd.choice(letters) for _ in range(rnd.choice([2, 20, 120, 198, 203, 260, 700])))
        b = "".join(rnd.choice(["", c + rnd.choice("zq"), rnd.choice(letters)]) if rnd.random() < 0.2 else c for c in a) or "x"
        gram = 2 if len(b) < 200 else 5
        left = list(_near_in_cell(frame(1, a, gram), frame(2, b, gram), gram, 0.85, 0, 2))
        kept += bool(left)
        assert left or difflib.SequenceMatcher(None, a, b).ratio() < 0.85
    assert kept > 300
    syllables = "th he in er an re on ed nd ou ea ti es or st ing ion ly is".split()
    texts = ["".join(rnd.choice(syllables) + rnd.choice(["", "", " "]) for _ in range(600)) for _ in range(120)]
    cell = pd.concat([frame(i, t, 5) for i, t in enumerate(texts)], ignore_index=True)
    start = time.process_time()
    assert len(list(_near_in_cell(cell[:60], cell[60:], 5, 0.85, 0, 60))) == 0 and time.process_time() - start < 1


def test_claims_with_many_near_abstracts(spark):
    """The nearest by grams are walked first, the others in later turns."""
    rnd = random.Random(5)
    text = "".join(chr(0x4E00 + rnd.randrange(150)) for _ in range(300))
    edit = lambda k, at=0: "".join("#" if i % k == at else c for i, c in enumerate(text))
    abstracts = [edit(6, i % 6) + str(i) for i in range(40)] + [text[150:] + text[:150], edit(9)]
    asked = [text, edit(40), edit(4, 3), "x" + text]
    flat = lambda t: t.lower()
    want = [100 + i for i, a in enumerate(asked) if any(difflib.SequenceMatcher(None, flat(a), flat(t)).ratio() >= 0.85 for t in abstracts)]
    rows = [(1, i, t, "abstract", "x") for i, t in enumerate(abstracts)] + [(1, 100 + i, t, "other", "Key Messages") for i, t in enumerate(asked)]
    df = spark.createDataFrame(rows, "g int, claim_id int, claim string, semantic_category string, section_heading string")
    for first in (1, 50):
        assert sorted(r.claim_id for r in D.dup_of_abstract(df, ["g"], first=first).collect()) == want
    assert 0 < len(want) < len(asked)
