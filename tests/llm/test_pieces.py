"""Operator 11 against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from attestra.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts_of_all_kinds(library):
    rnd = random.Random(5)
    vocabulary = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    letters = [v.strip() for v in vocabulary if v.strip().isalpha()]
    texts = ["", " ", "  ", "a ", "  a  b ", "▁x▁▁y", "a\nb\r\n", "x" * 50, "ab" * 300, " " * 9000, "日本語" * 40, "🙂é̂ñ×ł", "\x00\x01", "<s> </s> <unk> <0x41>", "हिन्दी", "1234567 89"]
    texts.append("".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCXYZ0123456789+/") for _ in range(9000)))  # one word, merged by the heap
    texts += ["".join(rnd.choice("abcdeéñßthion ▁  \n.,;()\"'<>0123日🙂ő") for _ in range(rnd.randrange(40))) for _ in range(1500)]
    texts += ["".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(12))) for _ in range(1500)]
    texts += [(rnd.choice(letters) + rnd.choice(letters)) * rnd.randrange(1, 30) for _ in range(500)]
    return texts


def test_ids_and_texts_are_those_of_the_library(spark, library):
    texts = texts_of_all_kinds(library)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in pieces.decode(pieces.encode(docs, PATH), PATH).collect()}
    want = library.encode(texts)
    for i, ids in enumerate(want):
        assert got[i].ids == ids, texts[i][:80]
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded == library.decode(ids)


def test_rounds_and_heap_agree(library):
    model = pieces.model_of(PATH)
    rnd = random.Random(7)
    words = ["".join(rnd.choice(" tehinorsa") for _ in range(rnd.randrange(1, 60))).replace(" ", "▁") for _ in range(800)]
    flat, counts = model.rounds(words)
    at = 0
    for w, n in zip(words, counts, strict=True):
        assert flat[at:at + n].tolist() == model.alone(model.first[[ord(c) for c in w]].tolist())
        at += n


def test_words_are_learned_anew(monkeypatch, library):
    import pyarrow as pa

    monkeypatch.setattr(pieces, "KEEP_WORDS", 20)
    monkeypatch.setattr(pieces, "BATCH", 10)
    texts = [f"word{i} and the {i * 37} other" for i in range(60)]
    batch = pa.record_batch([pa.array(range(60)), pa.array(texts)], ["doc_id", "text"])
    got = [ids for out in pieces.coded(PATH)(iter([batch])) for ids in out.column(1).to_pylist()]
    assert got == library.encode(texts)


def test_decode_of_any_ids(spark, library):
    rows = [[], [1, 264, 2], [3, 4], [0, 264], [259, 264], [264, 230, 231], [28705, 31759], [130, 131, 264], None]
    got = pieces.decode(spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "n int, ids array<int>"), PATH).orderBy("n").collect()
    assert [r.decoded for r in got] == [library.decode(r) if r else "" for r in rows]


def test_odd_rows_and_no_rows(odd, odd_rows, none, library):
    got = pieces.decode(pieces.encode(odd, PATH), PATH)
    assert sorted((str(r.doc_id), tuple(r.ids), r.decoded) for r in got.collect()) == sorted(
        (str(r[0]), tuple(library.encode(r[1] or "")), library.decode(library.encode(r[1] or ""))) for r in odd_rows)
    assert pieces.decode(pieces.encode(none, PATH), PATH).count() == 0
    named = pieces.encode(odd.withColumn("name", F.concat(F.lit("d"), F.col("doc_id").cast("string"))), PATH, id_col="name")
    assert named.schema["doc_id"].dataType.simpleString() == "string" and named.count() == len(odd_rows)


def test_query_over_all_documents(spark, sf, library):
    from __spark_entry__ import queries

    got = {r.doc_id: r for r in queries()["op11_merge_rounds"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "")
        assert (got[d.doc_id].n_tokens, got[d.doc_id].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
