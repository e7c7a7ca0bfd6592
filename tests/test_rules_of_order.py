"""Answers that the driver tables' unique ids and short texts do not show."""

import difflib
import random
import tempfile

from pyspark.sql import functions as F

from attestra.operators import citations as C
from attestra.operators import dedupe as D
from attestra.operators import lines as L
from attestra.streaming import rounds as ST


def test_findings_whose_sequence_restarts_per_group(spark):
    rows = [("g1", 1, "the team is small and new"), ("g1", 2, "team is small"), ("g2", 1, "funds are named nowhere at all"), ("g2", 2, "another thing is missing here"), ("g2", 3, ""), ("g1", 3, "")]
    got = D.dedupe_findings(spark.createDataFrame(rows, "g string, seq int, observation string"), ["g"], "seq").select("g", "seq").collect()
    assert sorted(map(tuple, got)) == [("g1", 1), ("g1", 3), ("g2", 1), ("g2", 2), ("g2", 3)]


def test_findings_in_long_chains(spark):
    """Every text repeats the one before it, so every other one is kept; two groups with the same numbers."""
    rows = [(g, i, " ".join(f"w{k}" for k in range(i, i + 9))) for g in ("a", "b") for i in range(0, 12)]
    kept = []
    for i in range(12):
        own = set(range(i, i + 9))
        if not any(len(own & set(range(k, k + 9))) / 9 > 0.75 for k in kept):
            kept.append(i)
    got = D.dedupe_findings(spark.createDataFrame(rows, "g string, seq int, observation string"), ["g"], "seq").select("g", "seq").collect()
    assert sorted(map(tuple, got)) == [(g, i) for g in ("a", "b") for i in kept]


def test_near_abstracts_against_a_walk(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(60)]
    rows, pairs = [], {}
    for g in range(200):
        abstract = " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 4, 8, 14])))
        claim = list(abstract)
        for _ in range(int(len(claim) * rnd.choice([0.1, 0.2, 0.25, 0.3, 0.4]))):
            at = rnd.randrange(len(claim))
            claim[at:at + 1] = rnd.choice([[], [claim[at], rnd.choice("xyz")], [rnd.choice("xyz")]]) if len(claim) > 1 else claim
        rows += [(g, 2 * g, abstract, "Abstract", "abstract"), (g, 2 * g + 1, "".join(claim), "Key Messages", "other")]
        norm = lambda s: " ".join(s.lower().split())
        pairs[2 * g + 1] = norm("".join(claim)) != "" and difflib.SequenceMatcher(None, norm("".join(claim)), norm(abstract)).ratio() >= 0.85
    df = spark.createDataFrame(rows, "g int, claim_id int, claim string, section_heading string, semantic_category string")
    got = {r.claim_id for r in D.dup_of_abstract(df, ["g"]).collect()}
    assert got == {k for k, v in pairs.items() if v} and 30 < len(got) < 170


def test_context_has_both_layers(spark):
    chunks = [("d", i, h, t) for i, (h, t) in enumerate([("Intro", "a" * 10), ("Methods", "b" * 5000), ("Results", "c" * 10), ("Data", "e" * 7000), ("Conclusion", "f")])]
    claims = [(1, "d", 0, "Fact"), (2, "d", 2, "Other"), (3, "none", 0, "Fact"), (4, "d", 4, None)]
    got = {r.claim_id: r.context for r in C.context_sections(spark.createDataFrame(claims, "claim_id int, doc_name string, chunk_id int, claim_type string"), spark.createDataFrame(
        chunks, "doc_name string, chunk_id int, section_heading string, text string")).collect()}
    part = {i: f"[{h}]\n{t}" for _, i, h, t in chunks}
    cut = lambda parts, n: "\n\n".join(p for p in [parts[0][:n], *([parts[1][:n - len(parts[0])]] if len(parts) > 1 and len(parts[0]) < n else [])] if p)
    assert got == {1: cut([part[0], part[1]], 3000) + "\n\n" + cut([part[2], part[3]], 3000), 2: part[1][:3000] + "\n\n" + part[4],
                   3: C.NO_CONTEXT, 4: part[3][:3000] + "\n\n" + cut([part[1]], 3000)}


def test_field_keeps_strings(spark):
    doc = '{"research_name":"2024","x":"[a]","n":1.5,"t":true,"u":"true","z":null,"o":{"a":[1,"2"]}}'
    put = lambda d: spark.range(1).select(L.with_field_after(F.lit(d), "evidence_audit", F.lit("tx")).alias("v")).first().v
    assert put(doc) == doc.replace('"2024",', '"2024","evidence_audit":"tx",')
    assert put("{}") == put('{"evidence_audit":"old"}') == '{"evidence_audit":"tx"}'


def test_status_markers(spark):
    log = spark.createDataFrame([("r", 1, "== Step 1 — Crawl =="), ("r", 2, "Step 2 - hyphen"), ("r", 3, "Step 6 — audit")], "run_id string, event_id int, line string").withColumn("ts", F.timestamp_seconds("event_id"))
    assert [r.status for r in ST.status_changes(log).orderBy("event_id").collect()] == ["crawling", "reviewing"]


ROWS = [("A", "s1", "k1"), ("A", "s1", "k2"), ("A", "s2", "k2"), ("A", "s1", None), ("A", "s1", None), ("B", "s1", "k1"), ("B", "s2", "k9"), ("B", "s2", "k9"), ("A", "s2", "k3"), ("A", "s2", "k4"), ("A", "s2", "k5")]
STORED = [("B", "s1", "k1"), ("A", "s2", "k3"), ("B", "s2", "k0"), ("B", "s2", None)]
CAPS = {"s1": (3, 9), "s2": (1, 3)}


def test_rounds_are_per_item(spark):
    schema = "compound string, source_type string, material_key string"
    new, stored = spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], schema + ", at int"), spark.createDataFrame(STORED, schema)
    got = {r.at for r in ST.discover_round(new, stored, ["compound"], "source_type", "material_key", ["at"], CAPS).collect()}
    assert got == {0, 1, 3, 6, 9}  # k1 of A is new though B has it; A's s2 has room for one row a round
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    src, out = tempfile.mkdtemp(prefix="spark-", dir="/tmp"), tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    new.coalesce(1).write.mode("overwrite").parquet(src)
    stream = ST.discover_stream(spark.readStream.schema(new.schema).parquet(src), "compound", "source_type", caps=CAPS, stored=stored)
    query = ST.write_rounds(stream, f"{out}/rounds", lambda df: df.withColumn("tag", F.lit("new")), f"{out}/checkpoint")
    query.awaitTermination(200)
    assert {r.at for r in spark.read.parquet(f"{out}/rounds").collect()} == got
