"""Operator 10 where many sets share their keys: the second index, against every pair."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from attestra.llm import jaccard


def near_copies(seed, n, size, edits):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(5000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rnd.randrange(edits)):
            words[rnd.randrange(size)] = f"x{rnd.randrange(40)}"
        out.append(" ".join(words))
    return out


def plain_components(texts, width, percent):
    sets = [jaccard.shingles(t, width) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if jaccard.linked(sets[i], sets[j], percent):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize(("few", "width", "percent"), [(64, 4, 85), (1, 5, 80)])
def test_crowded_keys_lose_no_link(spark, monkeypatch, few, width, percent):
    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(jaccard, "PICKS", 1)
    texts = near_copies(3, 110, 150, 12) + near_copies(4, 40, 40, 5) + near_copies(5, 10, 900, 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, width=width, percent=percent).collect()}
    assert [got[i] for i in range(len(texts))] == plain_components(texts, width, percent)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.booleans())
def test_any_keys_that_are_looked_up_find_linked_sets(size, seed, first):
    """Whichever keys the smaller set takes, as many as are needed, one of them is a key of the larger set in the same scheme."""
    r = np.random.default_rng(seed)
    percent = 85
    common = r.integers(1, 1 << 63, size, dtype="u8")
    for extra in range(0, size // 5 + 1, max(1, size // 20)):
        a, b = np.unique(common), np.unique(np.concatenate([common[extra // 2:], r.integers(1, 1 << 63, extra - extra // 2, dtype="u8")]))
        if not len(b) or not jaccard.linked(a, b, percent):
            continue
        if len(a) > len(b):
            a, b = b, a
        schemes = jaccard.Schemes(percent)
        held = {k for _, _, keys in schemes.spare(b) for k in keys.tolist()}
        need, keys = next((need, keys) for need, asks, keys in schemes.spare(a) if asks)
        taken = sorted(keys.tolist(), key=lambda k: (k in held) == first)[:need]
        assert any(k in held for k in taken)


def test_wide_sketches_rule_out_long_texts_before_they_move(spark):
    """Sets of thousands of shingles differ in more than a sketch of 1024 bits can tell; no linked pair is ruled out."""
    r = np.random.default_rng(5)
    base = r.integers(1, 1 << 63, 6000, dtype="u8")
    sets = [np.unique(np.concatenate([base[:n], r.integers(1, 1 << 63, 6000 - n, dtype="u8")])) for n in (6000, 5990, 5500, 5400, 4400, 3000)] + [np.unique(base[:3900])]
    wides = [jaccard.wide_sketch(s) for s in sets]
    kept = {(i, j) for i in range(len(sets)) for j in range(i) if jaccard.within(wides[i], wides[j], len(sets[i]) + len(sets[j]), 80)}
    links = {(i, j) for i in range(len(sets)) for j in range(i) if jaccard.linked(sets[i], sets[j], 80)}
    assert links and links <= kept
    assert not any(5 in pair for pair in kept)  # half of its shingles are its own
    most = 12000 - 2 * -(-80 * 12000 // 180)
    assert int(np.bitwise_count((jaccard.sketch(sets[0]) ^ jaccard.sketch(sets[5])).view("u8")).sum()) <= most  # 1024 bits leave it possible
    base = spark.createDataFrame([(i, len(s), bytearray(w.tobytes())) for i, (s, w) in enumerate(zip(sets, wides, strict=True))] + [(90, 40, None)], "node long, n_shingles long, wide binary")
    pairs = spark.createDataFrame([(j, i) for i in range(len(sets)) for j in range(i)] + [(0, 90)], "a long, b long")
    assert {(p.b, p.a) for p in jaccard.close(pairs, base, 80).collect()} == kept | {(90, 0)}


def test_a_session_keeps_its_batch_size(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key)
    jaccard.jaccard_components(spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string"))
    assert spark.conf.get(key) == was
