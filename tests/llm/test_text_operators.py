"""Operators on the documents' texts against brute force, with odd rows, and on empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from attestra.llm import bpe, dac, decontaminate, jaccard, licenses, lines, pii
from attestra.llm.words import piece_bytes, words_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def u4(ids):
    return np.array(ids, "<u4").tobytes()


ODD_TEXT = st.lists(st.sampled_from(list("abzAZé ß\n\t'.,!#1½²́\x1c\x85日🙂ªΣİ　") + ["<|endoftext|>", "'s", "  "]), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(ODD_TEXT)
def test_words_carry_the_tokens_of_the_text(text):
    w = words_of(BYTE)
    assert b"".join(w.ids(x) for x in w.split(text)) == u4(w.encode(text))
    assert b"".join(piece_bytes(BYTE)[i] for i in w.encode(text)).decode("utf-8", "replace") == w.tokenizer.decode(w.encode(text), skip_special_tokens=False)
    v = words_of(WORD)
    assert v.text_ids(text) == u4(v.encode(text))


def test_bpe_round_trip(spark, odd, odd_rows, none):
    t = Tokenizer.from_file(BYTE)
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in bpe.decode(bpe.encode(odd, BYTE), BYTE).collect())
    want = Counter()
    for i, text, *_ in odd_rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[i, tuple(ids), t.decode(ids, skip_special_tokens=False)] += 1
    assert got == want
    assert bpe.decode(bpe.encode(none, BYTE), BYTE).count() == 0
    broken = spark.createDataFrame([(1, [159, 1]), (2, None), (3, [])], "k int, ids array<int>")
    assert [r.decoded for r in bpe.decode(broken, BYTE).orderBy("k").collect()] == [t.decode([159, 1]), "", ""]


def test_bpe_blocks(spark, odd, monkeypatch):
    """Small blocks and one bucket give the same ids."""
    whole = sorted(map(str, bpe.encode(odd, BYTE).collect()))
    assert sorted(map(str, bpe.encode(odd, BYTE, buckets=1).collect())) == whole
    block = bpe.Block()
    block.add(1, ["a", "b", "a"])
    block.add(2, ["b", "cc"])
    assert [p.tolist() for p in block.places] == [[0, 1, 0], [1, 2]] and block.distinct_chars == 4


def test_addressable_codes(spark, odd, odd_rows, none, tmp_path):
    folder = str(tmp_path / "ids")
    got = dac.read_ids(dac.write_ids(odd, WORD, folder), folder).orderBy("start", "n_tokens").collect()
    t = Tokenizer.from_file(WORD)
    want = Counter((i, len(ids), zlib.crc32(u4(ids))) for i, text, *_ in odd_rows for ids in [t.encode(text or "", add_special_tokens=False).ids + [1]])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda x: (x is not None, x))
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    empty = str(tmp_path / "none")
    assert dac.read_ids(dac.write_ids(none, WORD, empty), empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), st.data())
def test_any_token_is_found(ids, data):
    r = dac.Reader(dac.dac_bytes(np.array(ids, "<u4"), np.array([5]), np.array([1]), np.array([0, len(ids)])))
    assert r.run(0, len(ids)).tolist() == ids
    if ids:
        i = data.draw(st.integers(0, len(ids) - 1))
        j = data.draw(st.integers(i, len(ids)))
        assert r.get(i) == ids[i] and r.run(i, j).tolist() == ids[i:j]
    with pytest.raises(IndexError):
        r.get(len(ids))


def test_pseudonyms(spark, odd, odd_rows, none):
    p = pii.Permuter(b"key")
    for n in (1, 2, 3, 10, 257):
        assert sorted(p.permute(i, n, "t") for i in range(n)) == list(range(n))
    text = "+1 (743) 555-3824, 227.5.221.1. 300.1.1.1 4845168114407329 9807915762804490 1980-02-29 31.12.1999 02-30-2001 a.b@mail.example.com 123-45-6789 DE89 3704 0044 0532 0130 00 token = \"00ff00ff00ff00ff\""
    new, kinds = pii.hide(text, p)
    assert Counter(kinds) == Counter(["phone", "ip", "card", "date", "date", "email", "ssn", "iban", "secret"])
    shape = lambda s: re.sub("[0-9a-z]", "0", re.sub(r"\d+\.\d+\.\d+\.\d+", "IP", s))
    assert shape(new) == shape(text) and "9807915762804490" in new and "300.1.1.1" in new and "02-30-2001" in new
    for value in ("555-3824", "227.5.221.1", "4845168114407329", "1980-02-29", "31.12.1999", "a.b@", "123-45-6789", "00ff00ff00ff00ff"):
        assert value not in new
    card = re.search(r"\d{16}", new)[0]
    assert pii.luhn_digit(card[:-1]) == card[-1]
    iban = re.search(r"[A-Z]{2}\d{2}(?: \d{4})+ \d\d", new)[0].replace(" ", "")
    assert pii.mod97(iban[4:] + iban[:4]) == 1
    assert pii.hide("see 227.5.221.1 again", p)[0].split()[1] == re.search(r"\d+\.\d+\.\d+\.\d+", new)[0]  # linked across documents
    got = pii.pseudonymised(odd)
    assert got.columns == [c for c in odd.columns if c != "found"] + ["found"] and got.count() == len(odd_rows)
    assert Counter(got.select("doc_id", "text").collect()) == Counter(odd.select("doc_id", "text").collect())  # nothing personal in there
    assert pii.pseudonymised(none).count() == 0 and pii.pseudonymised(odd, found=None).columns == odd.columns

def test_single_digit_addresses_are_found():
    p = pii.Permuter(b"key")
    linked = pii.hide("ask 8.8.8.8 before 2001", p)[0].split()[1]
    assert linked != "8.8.8.8" and pii.hide("ask 8.8.8.8", p) == (f"ask {linked}", ["ip"]) and pii.hide("1.1.1.1", p)[1] == ["ip"]


@pytest.mark.parametrize("zero", ["٠", "०", "０"])
def test_digits_of_other_scripts(zero):
    """Values in other digits get the pseudonym of the same value in ASCII digits, written in their own."""
    p, own = pii.Permuter(b"key"), str.maketrans("0123456789", "".join(chr(ord(zero) + i) for i in range(10)))
    for value, kind in (("+1 (743) 555-3824", "phone"), ("4845168114407329", "card"), ("227.5.221.1", "ip"), ("8.8.8.8", "ip"), ("1980-02-29", "date"), ("123-45-6789", "ssn")):
        new, kinds = pii.hide(value, p)
        assert kinds == [kind] and pii.hide(value.translate(own), p) == (new.translate(own), [kind])
    assert pii.hide("9807915762804490".translate(own), p)[1] == []  # a wrong check digit


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_jaccard_components(spark, odd, odd_rows, none, width, percent):
    rnd = random.Random(5)
    rows = [(i, t) for i, t, *_ in odd_rows]
    for g in range(25):  # families of edited copies of every size
        base = [f"v{rnd.randrange(60)}" for _ in range(rnd.choice([1, 2, 3, 4, 5, 6, 8, 9, 12, 20, 40, 90, 200]))]
        for _ in range(8):
            edited = [w if rnd.random() > rnd.choice([0, 0.01, 0.03]) else "edit" + str(rnd.randrange(99)) for w in base]
            rows.append((1000 + len(rows), " ".join(edited)))
    sets = [jaccard.shingles(t or "", width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i]) and len(sets[j]) and jaccard.linked(sets[i], sets[j], percent):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    want = Counter((d, len(sets[i]), least.get(find(i), d) if len(sets[i]) else d) for i, (d, _) in enumerate(rows))
    docs = spark.createDataFrame([(*r, *("x",) * 3) for r in rows], "doc_id long, text string, row string, node string, key string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, width=width, percent=percent).collect())
    assert got == want
    if width == 5:
        kept = jaccard.one_of_each(docs)
        assert kept.columns == docs.columns  # row, node and key among them
        groups = {find(i) for i in range(len(rows)) if len(sets[i])}
        assert kept.count() == len(groups) + sum(not len(s) for s in sets)
        assert jaccard.one_of_each(none).count() == 0
    assert jaccard.jaccard_components(none).count() == 0


def test_shingles_are_the_words():
    plain = lambda t: {tuple(w[i:i + 4]) for w in [re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))] for i in range(max(1, len(w) - 3)) if w}
    for t in ("", " ", "A b", "a b c d e", "a b a b a b a", "É é x\x1cy z w", " lead a b c"):
        assert len(jaccard.shingles(t, 4)) == len(plain(t))
    assert jaccard.shingles("A B", 4).tolist() == jaccard.shingles("a  b\n", 4).tolist() != jaccard.shingles("a", 4).tolist()


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**9))
def test_linked_sets_share_a_key(size, seed):
    rnd = np.random.default_rng(seed)
    a = np.unique(rnd.integers(0, 1 << 63, size, dtype="u8"))
    cut = int(rnd.integers(0, max(1, int(0.18 * size)) + 1))
    more = int(rnd.integers(0, cut + 1))
    b = np.unique(np.concatenate([rnd.permutation(a)[cut - more:], rnd.integers(0, 1 << 63, more, dtype="u8")]))
    for percent in (80, 85):
        schemes = jaccard.Schemes(percent)
        if len(b) and jaccard.linked(a, b, percent):
            assert len(np.intersect1d(schemes.keys(a), schemes.keys(b)))


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 1500), st.integers(0, 1500), st.integers(0, 10**9))
def test_sketches_differ_in_no_more_bits_than_sets_in_shingles(common, more, seed):
    rnd = np.random.default_rng(seed)
    both, a, b = (rnd.integers(0, 1 << 63, k, dtype="u8") for k in (common, more, more // 2))
    a, b = np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))
    assert int(np.bitwise_count((jaccard.sketch(a) ^ jaccard.sketch(b)).view("u8")).sum()) <= len(np.setxor1d(a, b))


def test_decontamination(spark, odd, odd_rows, none):
    rnd = random.Random(4)
    items = [(i, " ".join(f"q{rnd.randrange(300)}" for _ in range(n))) for i, n in enumerate([1, 3, 4, 5, 9, 14, 20, 33, 34, 60, 200])] + [(50, None), (51, ""), (None, "x y"), (52, "no such words here at all today")]
    rows = [(i, t) for i, t, *_ in odd_rows]
    for i, t in items[:11]:
        w = t.split()
        changed = [*w[:len(w) // 2], "edited", *w[len(w) // 2 + 1:]]
        for body in (w, changed, w[1:], [*w[: len(w) // 2], *w[len(w) // 2 + 2:]]):
            lead = [f"z{rnd.randrange(500)}" for _ in range(rnd.randrange(90))]
            rows.append((1000 + len(rows), " ".join([*lead, *body, *[f"z{rnd.randrange(500)}" for _ in range(rnd.randrange(60))]])))
            rows.append((1000 + len(rows), " ".join(body).upper()))
    hashed = [(i, jaccard.word_hashes(t)) for i, t in items if i is not None and t]

    def brute(t):
        w, out = jaccard.word_hashes(t or ""), {}
        for i, q in hashed:
            for at in range(max(0, len(w) - len(q)) + 1):
                s = decontaminate.similarity(decontaminate.weights(q, 5), decontaminate.weights(w[at:at + len(q)], 5)) if len(w) else 0
                if s >= 0.8:
                    out[i] = max(out.get(i, 0), s)
        return sorted(out.items())

    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, leaks string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (2000, 4):
        got = decontaminate.leaks(docs, bench, block=block)
        assert got.columns == ["doc_id", "text", "item_id", "leaks"]
        key = lambda r: (r[0] is None, r[0], r[1] or "")
        found = sorted(((r.doc_id, r.text, [(x.item_id, x.similarity) for x in r.leaks]) for r in got.collect()), key=key)
        want = sorted(((d, t, brute(t)) for d, t in rows), key=key)
        assert found == want
    assert decontaminate.leaks(docs, bench.limit(0)).filter(F.size("leaks") > 0).count() == 0 and decontaminate.leaks(none, bench).count() == 0


def test_all_fingerprints_within_radius():
    """The multi-index against a comparison with every item."""
    rnd = random.Random(8)
    items = [(i, " ".join(f"q{rnd.randrange(90)}" for _ in range(rnd.choice([16, 17, 18, 30])))) for i in range(40)]
    index = decontaminate.Index(items, 5, 0.8)
    w = jaccard.word_hashes(" ".join(f"q{rnd.randrange(90)}" for _ in range(600)) + " " + " ".join(t for _, t in items))
    got = {(p, k) for places, ks in index.candidates(w, np.array([0]), np.array([len(w)])) for p, k in zip(places.tolist(), ks.tolist(), strict=True)}
    bits, want = decontaminate.pair_bits(w), set()
    for g in index.groups:
        for at in {*range(0, len(w) - g.size + 1, g.step), len(w) - g.size}:
            own = np.packbits(bits[at:at + g.size - 1].sum(axis=0) > 0).view("u8")[0]
            want |= {(at, int(k)) for k, q in zip(g.items, g.prints, strict=True) if int(own ^ q).bit_count() <= decontaminate.RADIUS}
    assert got == want and len({k for _, k in got}) == 40

def test_items_with_repeated_shingles():
    """A refrain and other words: the weighted rule holds where few of the distinct shingles are common."""
    rnd, tried = random.Random(6), 0
    for _ in range(30):
        item = [f"r{rnd.randrange(10**6)}" for _ in range(20)] * 4 + [f"o{rnd.randrange(10**6)}" for _ in range(9)]
        body = [*item[:-9], *(f"c{rnd.randrange(10**6)}" for _ in range(9))]
        a, b = (jaccard.word_hashes(" ".join(x)) for x in (item, body))
        near = int.from_bytes(decontaminate.fingerprint(a)) ^ int.from_bytes(decontaminate.fingerprint(b))
        if near.bit_count() <= decontaminate.RADIUS:
            want = decontaminate.similarity(decontaminate.weights(a, 5), decontaminate.weights(b, 5))
            assert want > 0.8 and decontaminate.Index([(1, " ".join(item))], 5, 0.8).found([" ".join(body)]) == [{1: want}]
            tried += 1
    assert tried > 20

def test_truncated_copies_in_a_group_of_mixed_sizes():
    """Whole documents shorter than the group's window, long enough for its smaller items."""
    rnd, tried = random.Random(7), 0
    for low, size, n in ((42, 46, 35), (47, 51, 39), (52, 56, 43), (30, 33, 25)):
        for _ in range(20):
            items = [(i, " ".join(f"q{rnd.randrange(10**6)}" for _ in range(m))) for i, m in enumerate((low, size))]
            index, w = decontaminate.Index(items, 5, 0.8), items[0][1].split()
            assert len(index.groups) == 1
            for body in (w[:n], w[-n:]):
                a, b = (jaccard.word_hashes(" ".join(x)) for x in (w, body))
                near = int.from_bytes(decontaminate.fingerprint(a)) ^ int.from_bytes(decontaminate.fingerprint(b))
                want = decontaminate.similarity(decontaminate.weights(a, 5), decontaminate.weights(b, 5))
                if near.bit_count() <= decontaminate.RADIUS and want >= 0.8:
                    assert index.found([" ".join(body)]) == [{0: want}]
                    tried += 1
    assert tried > 40


def brute_measures(t):
    w = re.findall(r"[^\x20\x09-\x0d]+", t)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = {i + k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(8)}
    ls = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(ls) - len(set(ls)), len(rep)


def test_line_rules(spark, odd, odd_rows, none):
    got = lines.line_rules(odd, with_text=True)
    want = Counter((i, *brute_measures(t or "")) for i, t, *_ in odd_rows)
    rows = got.collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and r.kept == (not r.base_failed)
    assert lines.line_rules(none).count() == 0
    rnd = random.Random(2)
    own = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    common = "The  same 12 words stand in every one of these documents of a host"
    docs = [(i, f"{common}\n{own(30)}\n{common.upper().replace('12', '77')}", "a") for i in range(6)] + [(10 + i, f"{common}\n{own(8)}", "b") for i in range(6)] + [
        (20, f"{common}\n{own(30)}", "c"), (21, f"{own(40)}", "b")]
    docs.append(docs[-1])
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r.doc_id: (r.kept, r.cleaned) for r in lines.line_rules(df, limit=5, with_text=True).collect()}
    assert all(got[i] == (True, docs[i][1].split("\n")[1]) for i in range(6)) and not any(got[10 + i][0] for i in range(6))
    assert got[20] == (True, docs[12][1]) and got[21] == (True, docs[13][1])


def test_documents_are_counted_once(spark):
    line = "a line that many rows of a single document hold again and again here"
    own = lambda i: " ".join("abcdefghi"[i] * (k + 1) for k in range(30))  # noqa: E731  digits would not tell lines apart
    rows = [(1, f"{line}\n{own(0)}", "a")] * 9 + [(1, f"{line}\n{own(i)}", "a") for i in range(9)] + [(i, f"{line}\n{own(i)}", "b") for i in range(6)] + [(None, f"{line}\n{own(i)}", "c") for i in range(6)]
    got = lines.line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), limit=5, with_text=True).collect()
    assert len(got) == len(rows) and all(r.kept for r in got)
    cut = Counter((r.doc_id, r.cleaned.startswith(line)) for r in got)
    assert cut[(1, True)] == 18 and cut[(1, False)] == 1  # one document of host a, one of the six of host b
    assert cut[(None, False)] == 6 and all(cut[(i, False)] == 1 for i in (0, 2, 3, 4, 5))


def test_license_scan(spark, odd, odd_rows, none):
    head = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"
    docs = [(1, "Text.\nReleased under the MIT License.\nMore"), (2, head), (3, "THIS WORK is licensed under the GNU General Public License, version 3. All rights reserved."), (4, None), (5, ""),
            (6, "You may obtain a copy of the License at x; you may not use this file except in compliance with the License."), (1, "Text.\nReleased under the MIT License.\nMore"), (None, "Licensed under CC BY-NC 4.0."), (7, "the mit license")]
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, row string, licenses string")
    got = Counter((r.doc_id, r.n_sentences, r.sentence_ids, r.versions, r.licenses) for r in licenses.license_scan(df).collect())
    want = Counter([(1, 1, "MIT-NAME", "", "MIT")] * 2 + [(2, 3, "APACHE-HEAD APACHE-COMPLY APACHE-COPY", "2.0", "Apache"), (3, 2, "GPL-NAME RIGHTS", "3", "GPL Proprietary"), (4, 0, "", "", ""), (5, 0, "", "", ""),
                    (6, 1, "APACHE-COMPLY", "", ""), (None, 1, "CC-BY-NC-NAME", "4.0", "CC-BY-NC"), (7, 0, "", "", "")])
    assert got == want
    assert licenses.license_scan(none).count() == 0 and licenses.license_scan(odd).count() == len(odd_rows)

MIT = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Copyright (c) 2020, A. Person

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""


def test_whole_licenses(spark):
    """Canonical texts as they are wrapped, as comments, with carriage returns and on one line; titles and SPDX tags."""
    texts = {"MIT": (MIT, "MIT-GRANT MIT-NOTICE MIT-WARRANTY"), "BSD": (BSD, "BSD-GRANT BSD-SOURCE BSD-BINARY BSD-WARRANTY"),
             "GPL": (GPL, "GPL-FREE GPL-TERMS GPL-WARRANTY"), "Apache": (APACHE, "APACHE-HEAD APACHE-COMPLY APACHE-COPY APACHE-WARRANTY")}
    docs, want = [], {}

    def add(text, ids, name):
        want[len(docs)] = (ids, name)
        docs.append((len(docs), text))

    for name, (text, ids) in texts.items():
        for body in (text, text.replace("\n", "\r\n"), "/*\n" + re.sub("(?m)^", " * ", text) + "/\n", re.sub("(?m)^", "# ", text)):
            add(body, ids, name)
        if name != "Apache":  # on one line the address and the sentence after it are one
            add(" ".join(text[text.index("\n\n") if name == "MIT" else 0:].split()).replace("A. Person", "Person."), ids, name)
    add("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007", "GPL-TITLE", "GPL")
    add("        Apache License\n   Version 2.0, January 2004\n   http://www.apache.org/licenses/\n\n   TERMS", "APACHE-TITLE", "Apache")
    for tag, ids, name in (("MIT", "MIT-NAME", "MIT"), ("Apache-2.0", "APACHE-NAME", "Apache"), ("GPL-2.0", "GPL-NAME", "GPL"), ("GPL-3.0-only", "GPL-NAME", "GPL"),
                           ("GPL-3.0-or-later", "GPL-NAME", "GPL"), ("BSD-3-Clause", "BSD-NAME", "BSD"), ("CC-BY-SA-4.0", "CC-BY-SA-NAME", "CC-BY-SA")):
        add(f"// SPDX-License-Identifier: {tag}\n// Copyright: A. Person\nint x;", ids, name)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.sentence_ids, r.licenses) for r in licenses.license_scan(df).collect()} == want


def test_digest_columns(spark, sf):
    from attestra.llm import QUERIES

    r = QUERIES["op1_distinct_word_bpe"](spark, sf).filter("doc_id = 3").first()
    text = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id = 3").first().text
    ids = Tokenizer.from_file(BYTE).encode(text, add_special_tokens=False).ids
    assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(u4(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
