"""Reply trees, sharding, classifier, components and the pipeline against brute force, with odd rows, and on empty tables."""

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from attestra.llm import QUERIES, chat, common, quality, sharding
from attestra.llm.components import components, merged
from pyspark.sql import functions as F


def test_reply_trees(spark):
    rnd = random.Random(3)
    nodes, parents = [], {}
    for tree in range(12):
        n = rnd.choice([1, 2, 5, 30, 70])
        for i in range(n):
            parent = None if i == 0 else rnd.choice([i - 1, rnd.randrange(i)])
            parents[tree, i] = parent
            nodes.append((f"t{tree}", i, parent, rnd.choice(["user", "assistant", None]), rnd.choice(["a < b", "</turn>\n<turn user>", "\\l \\b \\", None, "", "x\n" * 3]), rnd.choice([None, 0.0, 1.0, 2.5]), "clash"))
    nodes.append((*nodes[0][:6], "clash"))  # a repeated row
    nodes += [("cycle", 1, 2, "user", "a", 1.0, "x"), ("cycle", 2, 1, "user", "b", 1.0, "x"), ("orphan", 5, 99, "user", "root all the same", 1.0, "x")]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, role string, text string, score double, place string")
    got = {(r.tree, r["rank"]): r for r in chat.read_back(chat.format_trees(df, per_tree=2)).collect()}
    by_tree = defaultdict(dict)
    for t, i, p, role, text, score, _ in nodes:
        by_tree[t][i] = (p, role or "", text or "", score or 0.0)
    expected = 0
    for t, own in by_tree.items():
        if t == "cycle":
            continue
        inner = {p for p, *_ in own.values()}
        ranked = []
        for leaf in (i for i in own if i not in inner):
            path, at = [], leaf
            while at is not None and at in own:
                path.append(at)
                at = own[at][0]
            ranked.append((-sum(own[i][3] for i in path) / len(path), leaf, path[::-1]))
        for k, (_, leaf, path) in enumerate(sorted(ranked)[:2], 1):
            r = got[t, k]
            expected += 1
            assert r.leaf == leaf
            assert [(x.role, x.text) for x in r.turns] == [own[i][1:3] for i in path]
            assert r.loss_text == "".join(own[i][2] for i in path if own[i][1] == "assistant")
            assert [r.formatted[s.start:s.start + s.length] for s in r.loss] == [own[i][2].replace("\\", "\\b").replace("<turn", "\\lturn").replace("</turn", "\\l/turn") for i in path if own[i][1] == "assistant"]
    assert expected == len(got)
    assert chat.format_trees(df.limit(0)).count() == 0


def test_conversations_with_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 2, None, None), (None, 1, "user", "x"), (None, None, "assistant", "y"), (2, 5, "assistant", "b" * 100_000), (2, -1, "a>b\nc", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.tree: [(t.role, t.text) for t in r.turns] for r in chat.read_back(chat.format_trees(chat.chains(df))).collect()}
    assert got == {"1": [("user", "a"), ("user", "a"), ("", "")], "null": [("assistant", "y"), ("user", "x")], "2": [("a>b\nc", ""), ("assistant", "b" * 100_000)]}
    assert chat.format_trees(chat.chains(df.limit(0))).count() == 0


def brute_gapless(rows):
    seen = Counter()
    for r in sorted(rows, key=lambda r: (r.shard, r.doc_id is not None, r.doc_id or 0, r.slot)):
        assert r.slot == seen[r.shard]
        seen[r.shard] += 1


def test_sharding(spark, odd, odd_rows, none, sf):
    for docs, want in ((odd, odd_rows), (spark.read.parquet(f"{sf}/documents.parquet"), None)):
        want = want or [(r.doc_id, r.text) for r in docs.collect()]
        got = sharding.kd_shards(docs, shards=5).collect()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in want)
        assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None} and all(0 <= r.shard < 5 for r in got)
        brute_gapless(got)
    assert sharding.kd_shards(none).count() == 0


def test_shards_are_near_equal(spark):
    rnd = random.Random(1)
    rows = [(i, "x" * rnd.randrange(50, 400), rnd.choice(["en", "fr"]), f"src{rnd.randrange(9)}") for i in range(3000)]
    rows += [(5000 + i, "hot copy " * 20, "en", "src1") for i in range(1500)]  # a third of all rows
    rows += [(9000 + i, f"pair {i // 2} " * 20, "en", f"src{i % 9}") for i in range(400)]
    got = sharding.kd_shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), shards=8, tolerance=1 / 64).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and max(abs(s - mean) for s in sizes.values()) < 0.05 * mean
    by_text = defaultdict(set)
    for r in got:
        if r.doc_id >= 9000:
            by_text[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())  # small groups of equal texts stay together


def test_cells_are_boxes(spark, sf):
    """The first split is along the widest dimension, at the weighted median. Copies take the place of their least row, so they are left out here."""
    docs = common.stored(spark.read.parquet(f"{sf}/documents.parquet").dropDuplicates(["text"]), "single")
    got = {r.doc_id: r for r in sharding.kd_shards(docs, shards=4).collect()}
    place = {r.doc_id: r[1:] for r in docs.withColumn("size", F.octet_length("text") + 1).select("doc_id", *[c.alias(k) for k, c in sharding.metadata().items()]).collect()}
    lower, upper = ([i for i in got if got[i].shard in s] for s in ((0, 1), (2, 3)))
    spread = [max(p[k] for p in place.values()) - min(p[k] for p in place.values()) for k in range(3)]
    widest = max(range(3), key=lambda k: spread[k])
    assert max(int(place[i][widest] * (1 << 24)) for i in lower) <= min(int(place[i][widest] * (1 << 24)) for i in upper)
    assert abs(sum(got[i].size for i in lower) / sum(r.size for r in got.values()) - 0.5) < 0.05


def test_gapless(spark):
    rows = [(random.Random(i).randrange(3) if i % 7 else None, i if i % 5 else None) for i in range(500)]
    got = common.gapless(spark.createDataFrame(rows, "g int, o int"), "g", ["o"], "at").collect()
    for g in {r.g for r in got}:
        assert sorted(r["at"] for r in got if r.g == g) == list(range(sum(r.g == g for r in got)))
        own = sorted((r["at"], r.o) for r in got if r.g == g)
        assert [o for _, o in own] == sorted((o for _, o in own), key=lambda o: (o is not None, o or 0))


def test_components(spark):
    rnd = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 90)] + [(500, 500 + i) for i in range(1, 300)] + [(rnd.randrange(1000, 1300), rnd.randrange(1000, 1300)) for _ in range(160)] + [(7, 7), (None, 3), (90, 89)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert Counter((r.node, r.component) for r in got) == Counter((x, find(x)) for x in list(parent))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    df = lambda e: spark.createDataFrame(e, "a long, b long")
    whole = Counter(map(tuple, got))
    assert Counter(map(tuple, merged(components(df(edges[:100])), df(edges[100:])).collect())) == whole
    assert Counter(map(tuple, merged(components(df(edges)), df(edges[:50])).collect())) == whole


def test_gradients_follow_the_loss():
    """One step of plain descent along the model's own gradients lowers the loss; attention sums to one."""
    rnd = np.random.default_rng(1)
    bags = [rnd.normal(y, 1, (rnd.integers(1, 6), quality.N_FEATURES)).astype("f4") for y in [0, 1] * 40]
    y = np.array([0.0, 1.0] * 40)
    model = quality.fit(bags, y, epochs=6)
    assert ((model.score(bags) >= 0.5) == y).mean() > 0.95
    n = np.array([len(b) for b in bags])
    f = model.forward((np.concatenate(bags) - model.mean) * model.scale, np.cumsum(n) - n, np.repeat(np.arange(len(bags)), n))
    assert np.allclose(np.add.reduceat(f["a"], np.cumsum(n) - n), 1, atol=1e-5)
    again = quality.fit(bags, y, epochs=6)
    assert np.array_equal(model.score(bags), again.score(bags))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = QUERIES["op8_attention_quality"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    test = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in test) / len(test) > 0.93


def test_classifier_with_odd_rows(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(4, 1), (4, 1), (7, 0), (None, 1), (8, None), (9, 5), (999, 1), (11, 0), (100, 1), (100, 0)], "doc_id long, quality int")
    got = quality.classify(odd, labels)
    assert got.columns == [c for c in odd.columns if c != "score"] + ["score", "predicted"] and got.count() == len(odd_rows)
    by_text = defaultdict(set)
    for r in got.collect():
        by_text[r.text or ""].add(r.score)
    assert all(len(s) == 1 for s in by_text.values())  # only the text counts
    assert quality.classify(none, labels).count() == 0
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality.classify(odd, labels.filter("doc_id = 4")).collect()} == {1.0}


def test_ids_of_any_type(spark, odd):
    labels = spark.createDataFrame([("4", 1), ("7", 0), ("100", 0)], "doc_id string, quality int")
    named = odd.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert quality.classify(named, labels).count() == odd.count()
    bags, y = quality.labelled_sample(named, labels, 10, "text", "doc_id", "quality", most=50)
    assert len(bags) == 3 and sorted(y) == [0, 0, 1] and max(len(b) for b in bags) == 50  # the long document gives 50 of its passages


def test_stages_with_odd_rows(spark, odd, none, sf):
    """Clashing columns keep their values, rows stay whole, no rows give no rows."""
    columns = Counter(tuple(r) for r in odd.collect())
    for name, stage in corpus_pipeline.STAGES[:3]:
        got = stage(spark, odd, sf)
        assert got.columns == odd.columns and not Counter(tuple(r) for r in got.collect()) - columns, name
        assert stage(spark, none, sf).count() == 0, name
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter(~quality.held_out())
    good = quality.classify(odd.select("doc_id", "text"), labels).filter("score >= 0.7").count()
    assert corpus_pipeline.good_quality(spark, odd, sf).count() == good
    assert corpus_pipeline.without_benchmark(spark, odd, sf).count() == odd.count()
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    held = odd.withColumn("text", F.when(F.col("doc_id") == 8, item).otherwise(F.col("text")))
    assert corpus_pipeline.without_benchmark(spark, held, sf).exceptAll(odd).count() == 0 and corpus_pipeline.without_benchmark(spark, held, sf).filter("doc_id = 8").count() == 0
    got = corpus_pipeline.without_personal_data(spark, odd, sf)
    assert got.columns == odd.columns and got.drop("text", "n_chars").exceptAll(odd.drop("text", "n_chars")).count() == 0
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect()) and corpus_pipeline.without_personal_data(spark, none, sf).count() == 0
    assert corpus_pipeline.without_personal_data(spark, odd.drop("n_chars"), sf).count() == odd.count()
    got = corpus_pipeline.token_ids(spark, odd, sf)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((r.doc_id, r.text or "") for r in odd.collect()) and corpus_pipeline.token_ids(spark, none, sf).count() == 0


def test_passages_cover_the_whole_text():
    assert len(quality.passages("")) == 1 and len(quality.passages("w " * 1000)) == -(-1000 // quality.WORDS)
    a, b = quality.passages("plain words " * 400), quality.passages("plain words " * 399 + "#$%& ODD!!")
    assert np.allclose(a[:-1], b[:-1]) and not np.allclose(a[-1], b[-1])


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.stored(stage(spark, docs, sf), "stage")
        out.append((name, before, docs))
    return out


def test_pipeline(spark, sf, stages):
    names = spark.read.parquet(f"{sf}/documents.parquet").columns
    assert [n for n, _, _ in stages] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "PII", "BPE encoding and decoding"]
    assert all(after.columns == names for _, _, after in stages[:-1])
    for name, before, after in stages[:3]:  # filters: what stays is as it was
        assert 0 < after.exceptAll(before).count() + after.count() <= before.count(), name
    from attestra.llm import decontaminate, jaccard, pii

    _, before, after = stages[1]
    kept = [jaccard.shingles(r.text or "", 5) for r in after.collect()]
    assert not any(len(a) and len(b) and jaccard.linked(a, b, 80) for i, a in enumerate(kept) for b in kept[:i])
    gone = before.exceptAll(after).collect()
    assert gone and all(any(jaccard.linked(jaccard.shingles(r.text, 5), jaccard.shingles(o.text or "", 5), 80) for o in before.collect() if o.doc_id != r.doc_id and o.text) for r in gone)
    _, before, after = stages[2]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not any(i in (r.text or "") for r in after.collect() for i in items)
    index = decontaminate.Index(list(enumerate(items)), 5, 0.8)
    assert all(index.found([r.text])[0] for r in before.exceptAll(after).collect())
    _, before, after = stages[3]
    p, new = pii.Permuter(b"documents"), {r.doc_id: r for r in after.collect()}
    assert all(new[r.doc_id].text == (pii.hide(r.text, p)[0] if r.text is not None else None) for r in before.collect())
    _, before, after = stages[4]
    assert Counter((r.doc_id, r.text) for r in after.collect()) == Counter((r.doc_id, r.text or "") for r in before.collect())
    assert all(r.n_tokens == len(r.ids) for r in after.collect())


def test_run_gives_the_last_stage(spark, sf, stages):
    assert corpus_pipeline.run(spark, sf).select("doc_id").exceptAll(stages[-1][2].select("doc_id")).count() == 0
