"""BPE encoding and decoding over a distinct-word table (operator 1).

Encoding: tasks cut texts into words and number the distinct words of a block of documents. The blocks' word lists are shuffled by the
words' hash, so all occurrences of a word meet in one task, which encodes it once. The codes go back to the blocks by a join and are put
in the words' places. What moves is each block's word list and its documents as word numbers, never a row for a word of a text.
Decoding is a map-side join of ids with the id-to-piece table, which a vocabulary bounds; ``encode`` does it with the ids it has just made, if asked.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.llm.common import query, table
from attestra.llm.words import piece_bytes, words_of

#: A block of documents ends at either bound: word places, characters of distinct words.
BLOCK_WORDS, BLOCK_CHARS = 3_000_000, 6_000_000
#: Texts that a task turns into Python objects at a time.
SLICE = 256
#: Ids that a task holds at a time as it fills in or decodes documents; a longer document stands alone.
BATCH_IDS = 400_000


def pack(array: np.ndarray) -> bytes:
    return zstandard.compress(array.tobytes(), 3)


def unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


class Block:
    """Documents as numbers of their distinct words."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids: list = []
        self.sizes: list[int] = []
        self.places: list[np.ndarray] = []
        self.n = self.distinct_chars = 0

    def add(self, doc_id, words: list[str]) -> None:
        known, before = self.numbers, len(self.numbers)
        at = np.fromiter((known.setdefault(w, len(known)) for w in words), "<u4", len(words))
        self.distinct_chars += sum(map(len, islice(reversed(known), len(known) - before)))
        self.ids.append(doc_id)
        self.sizes.append(len(words))
        self.places.append(at)
        self.n += len(words)

    def full(self) -> bool:
        return self.n >= BLOCK_WORDS or self.distinct_chars >= BLOCK_CHARS

    def name(self, seq: int) -> str:
        """The same block in every attempt; other contents give another name, so a join that misses shows input that changed between attempts."""
        h = hashlib.blake2b(digest_size=12)
        for a in self.places:
            h.update(a.tobytes())
        h.update("\0".join(self.numbers).encode("utf-8", "surrogatepass"))
        return f"{TaskContext.get().partitionId()}-{seq}-{h.hexdigest()}"


def blocks_of(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[str, Block]]:
    split, block, seq = words_of(path).split, Block(), 0
    for b in batches:
        for i in range(0, b.num_rows, SLICE):
            part = b.slice(i, SLICE)
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                block.add(doc_id, split(text or ""))
                if block.full():
                    yield block.name(seq), block
                    block, seq = Block(), seq + 1
    if block.ids:
        yield block.name(seq), block


def word_lists(path: str, buckets: int):
    """block, bucket, place (the words' numbers), words: a block's distinct words, dealt to buckets by hash."""
    def run(batches):
        for name, block in blocks_of(batches, path):
            words = list(block.numbers)
            coded = [w.encode("utf-8", "surrogatepass") for w in words]
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in coded), "<u4", len(coded))
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in range(buckets):
                at = order[edges[k]:edges[k + 1]].astype("<u4")
                if len(at):
                    column = pa.array([words[i] for i in at], pa.large_string())
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, pa.schema([("w", pa.large_string())])) as out:
                        out.write_batch(pa.record_batch([column], ["w"]))
                    yield pa.record_batch([pa.array([name]), pa.array([k], pa.int32()), pa.array([pack(at)], pa.binary()),
                                           pa.array([zstandard.compress(sink.getvalue().to_pybytes(), 3)], pa.binary())], ["block", "bucket", "place", "words"])
    return run


def coded_lists(path: str):
    """block, bucket, place, sizes, codes: the distinct-word table's rows for each block; a word is encoded where it is first met and then known.

    Buckets have no word in common, so the worker forgets a task's words with it; else it would keep them through whatever it does next.
    """
    def run(batches):
        words_of(path).known.forget()
        yield from coded(batches, words_of(path).ids)
        words_of(path).known.forget()

    def coded(batches, ids):
        for b in batches:
            for name, bucket, place, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with pa.ipc.open_stream(zstandard.decompress(words)) as s:
                    coded = [ids(w) for w in s.read_all().column(0).to_pylist()]
                sizes = np.fromiter((len(x) // 4 for x in coded), "<u4", len(coded))
                flat = np.frombuffer(b"".join(coded), "<u4")
                yield pa.record_batch([pa.array([name]), pa.array([bucket], pa.int32()), pa.array([place], pa.binary()), pa.array([pack(sizes.astype("<u2") if sizes.max(initial=0) < 65536 else sizes)], pa.binary()),
                                       pa.array([pack(flat.astype("<u2") if flat.max(initial=0) < 65536 else flat)], pa.binary())], ["block", "bucket", "place", "sizes", "codes"])
    return run


def documents_of(path: str, id_type: pa.DataType):
    """block, ids, sizes, places, n_words: a block's documents as word numbers."""
    def run(batches):
        for name, block in blocks_of(batches, path):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("id", id_type)])) as out:
                out.write_batch(pa.record_batch([pa.array(block.ids, id_type)], ["id"]))
            yield pa.record_batch([pa.array([name]), pa.array([zstandard.compress(sink.getvalue().to_pybytes(), 3)], pa.binary()), pa.array([pack(np.array(block.sizes, "<u4"))], pa.binary()),
                                   pa.array([pack(np.concatenate(block.places))], pa.binary()), pa.array([len(block.numbers)], pa.int64())], ["block", "ids", "sizes", "places", "n_words"])
    return run


def narrow(data: bytes, n: int) -> np.ndarray:
    """n unsigned numbers of 2 or 4 bytes."""
    raw = zstandard.decompress(data)
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")


def filled(path: str, decoded: str | None):
    """doc_id, ids, the digest of the ids, and the text they stand for if ``decoded`` names a column: every word number replaced by the word's codes.

    One block is unpacked at a time, and ids are read back where they are made, so that no second worker beside this one holds them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None if decoded is None else pa.array(piece_bytes(path), pa.large_binary())
        for b in batches:
            for i in range(b.num_rows):
                for doc_id, ids, shas in documents(b.slice(i, 1).to_pylist()[0]):
                    yield pa.record_batch([doc_id, ids, shas] + ([] if pieces is None else [texts_of(ids, pieces)]), ["doc_id", "ids", "ids_sha256"] + ([] if decoded is None else [decoded]))

    def documents(row: dict) -> Iterator[tuple[pa.Array, pa.ListArray, pa.Array]]:
        starts = np.zeros(row["n_words"], "<i8")
        lengths = np.full(row["n_words"], -1, "<i8")
        parts, base = [], 0
        for x in row.pop("lists") or []:
            at = unpack(x["place"], "<u4")
            size = narrow(x["sizes"], len(at)).astype("<i8")
            codes = narrow(x["codes"], int(size.sum()))
            lengths[at] = size
            starts[at] = base + np.cumsum(size) - size
            parts.append(codes)
            base += len(codes)
        if (lengths < 0).any():
            raise RuntimeError("a block's words are missing: the input changed between two attempts; store it before encoding")
        flat = np.concatenate(parts) if parts else np.zeros(0, "<u4")
        with pa.ipc.open_stream(zstandard.decompress(row["ids"])) as s:
            ids = s.read_all().column(0).combine_chunks()
        sizes, places = unpack(row["sizes"], "<u4").astype("<i8"), unpack(row["places"], "<u4")
        ends = np.concatenate([[0], np.cumsum(sizes)])
        words_at = np.concatenate([[0], np.cumsum(lengths[places])])[ends]  # tokens before each document
        first = 0
        while first < len(sizes):
            last = max(first + 1, int(np.searchsorted(words_at, words_at[first] + BATCH_IDS, "right")) - 1)
            got = places[ends[first]:ends[last]]
            n = lengths[got]
            total = int(n.sum())
            index = np.repeat(starts[got] - (np.cumsum(n) - n), n) + np.arange(total)
            offsets = (words_at[first:last + 1] - words_at[first]).astype("<i4")
            values = flat[index]
            shas = [hashlib.sha256(values[i:j].tobytes()).hexdigest() for i, j in pairwise(offsets.tolist())]
            yield ids.slice(first, last - first), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype("<i4"))), pa.array(shas, pa.string())
            first = last

    return run


def texts_of(column: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """Each row's pieces joined and read as UTF-8."""
    offsets = column.offsets.to_numpy().astype("<i8")
    taken = pieces.take(column.values.slice(offsets[0], offsets[-1] - offsets[0]))
    whole = pa.LargeListArray.from_arrays(pa.array(offsets - offsets[0]), taken)
    return pa.array([x.as_py().decode("utf-8", "replace") for x in pc.binary_join(whole, pa.scalar(b"", pa.large_binary()))], pa.string())


def encode(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", buckets: int | None = None, decoded: str | None = None) -> DataFrame:
    """doc_id, ids (array<int>) and ids_sha256 (of the ids as little-endian unsigned 32-bit integers) of every row, as the tokenizers library
    encodes the whole text without added special tokens; ``decoded`` names a column for the text that these ids stand for, as ``decode`` gives it.

    Null texts count as empty and have no ids; null and repeated ids are rows of their own; other columns are not read; no rows give no rows.
    The input must give the same rows per task in every attempt, as a file scan does: a block whose words are missing stops the job.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    words = rows.mapInArrow(word_lists(path, buckets), "block string, bucket int, place binary, words binary")
    coded = words.repartition(buckets, "bucket").mapInArrow(coded_lists(path), "block string, bucket int, place binary, sizes binary, codes binary")
    lists = coded.groupBy("block").agg(F.collect_list(F.struct("place", "sizes", "codes")).alias("lists"))  # at most ``buckets`` rows for a block
    documents = rows.mapInArrow(documents_of(path, id_type), "block string, ids binary, sizes binary, places binary, n_words long")
    joined = documents.join(lists, "block", "left").select("ids", "sizes", "places", "n_words", "lists")
    return joined.mapInArrow(filled(path, decoded), f"doc_id {kind.simpleString()}, ids array<int>, ids_sha256 string" + ("" if decoded is None else f", {decoded} string"))


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for, special tokens included: each id meets its piece, a row's bytes are joined and read as UTF-8.

    Bytes that are no UTF-8 become the replacement character; null ids give an empty text; an id outside the vocabulary stops the job.
    """
    schema = encoded.schema.simpleString()[len("struct<"):-1]
    out_names = [*encoded.columns, name]

    def run(batches):
        pieces = pa.array(piece_bytes(path), pa.large_binary())
        for b in batches:
            column = b.column(encoded_at)
            if column.null_count:
                column = pc.if_else(column.is_null(), pa.scalar([], column.type), column)
            ends, first = column.offsets.to_numpy(), 0
            while first < len(column):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + BATCH_IDS, "right")) - 1)
                yield pa.record_batch([*b.slice(first, last - first).columns, texts_of(column.slice(first, last - first), pieces)], out_names)
                first = last

    encoded_at = encoded.columns.index(ids)
    return encoded.mapInArrow(run, f"{schema.replace(':', ' ')}, {name} string")


@query("op1_distinct_word_bpe")
def op1_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    done = encode(table(spark, sf_dir, "documents"), path, decoded="decoded")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
