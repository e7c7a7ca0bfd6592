"""Words are encoded once while they are in use, whatever signs follow them and however many others pass."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard

from attestra.llm import bpe
from attestra.llm.bpe import blocks_of, coded_lists, decode, encode, narrow, pack
from attestra.llm.words import Known, Words, words_of


def test_words_in_use_outlive_a_full_table():
    asked = []
    known = Known(lambda w: asked.append(w) or w.encode(), keep=8)
    for i in range(200):
        assert known["often"] == b"often" and known[f"once{i}"] == f"once{i}".encode()
        assert len(known) + len(known.old) <= 8
    assert asked.count("often") == 1


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_letters_before_signs_are_encoded_once(file):
    w = Words(public_tokenizers.path(file), keep=6)
    for word in ("Straße", "Straße,", " Straße...", "été", "ÉTÉ", "été;", "***", ",", "a.b", "x", "漢字", " an", "an"):
        assert w.pieces(word) == w.encode(word) and w.ids(word) == b"".join(i.to_bytes(4, "little") for i in w.encode(word))


def test_words_of_any_case_have_one_entry():
    w = Words(public_tokenizers.path("word_bpe_49k.json"))
    w.text_ids("Straße STRASSE straße Und UND und, und uNd,")
    assert set(w.lowered) == {"straße", "strasse", "und", "und,", ","} and not w.known


def test_whole_texts_as_the_file_lowers_and_cuts_them():
    w = Words(public_tokenizers.path("word_bpe_49k.json"), keep=6)
    for text in ("", "\xa0\t\x85", "Don't 'S it'S ('s) rock'n'roll we'LL", "ÀÖØÞ×÷ªºµß ÿŸ", "x²½ 12,5 a1b2", "...,,! ¿Qué?«Sí»\xad\x00\x7f", "İi ΑΣ ΣΑ. ǅ ﬁ", "ÉTÉ’s “Été” 漢字 É e\u0301 \u0301",
                 "<|ENDOFTEXT|> A", "a<|endoftext|>B", "A\x1cB"):
        assert w.text_ids(text) == np.array(w.encode(text), "<u4").tobytes(), text


def test_a_worker_forgets_the_words_of_a_bucket(monkeypatch):
    """Buckets share no word; a reused worker would hold the words of all of them through later stages."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = pa.record_batch([pa.array([1, 2]), pa.array(["one two, one", None])], ["doc_id", "text"])
    monkeypatch.setattr(bpe, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    (name, block), = blocks_of(iter([docs]), path)
    sink = pa.BufferOutputStream()
    words = list(block.numbers)
    with pa.ipc.new_stream(sink, pa.schema([("w", pa.large_string())])) as out:
        out.write_batch(pa.record_batch([pa.array(words, pa.large_string())], ["w"]))
    lists = pa.record_batch([pa.array([name]), pa.array([0], pa.int32()), pa.array([pack(np.arange(len(words), dtype="<u4"))], pa.binary()),
                             pa.array([zstandard.compress(sink.getvalue().to_pybytes(), 3)], pa.binary())], ["block", "bucket", "place", "words"])
    row, = (b.to_pylist()[0] for b in coded_lists(path)(iter([lists])))
    known = words_of(path).known
    assert narrow(row["sizes"], len(words)).tolist() == [len(words_of(path).encode(w)) for w in words]
    assert not known and not known.old


def test_ids_are_read_back_by_the_worker_that_made_them(spark, tmp_path):
    """A second Python operator after the one that fills in ids would stand beside it in every task."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(1, "one two, one"), (None, None), (3, ""), (3, "\x00 \ufffd 漢字 <|endoftext|>\n\n x"), (2, "Été " * 3000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    once, twice = encode(docs, path, decoded="said"), decode(encode(docs, path), path, name="said")
    assert once.columns == twice.columns
    got, want = (sorted(map(repr, df.collect())) for df in (once, twice))
    assert got == want and sorted(r.said for r in once.collect()) == sorted(t or "" for _, t in rows)
    passes = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
    assert passes(once) == passes(twice) - 1 == 4
