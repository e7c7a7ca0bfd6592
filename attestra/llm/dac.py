"""Directly addressable codes for token ids (operator 7).

Documents are dealt to tasks by ranges of doc_id, and each task writes files. A file holds the ids of its documents in levels: level 0 has
the lowest chunk of every id, level k the next chunk of those ids that are not used up, with a bitmap of the ids that go on and a rank
directory over the bitmap. Any token is found by one look into each level; no block is decoded.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestra.llm.common import query, shared_path, stored, table
from attestra.llm.words import words_of

MAGIC, BITS, RANK_BLOCK = b"DACIDS01", 8, 512
#: A file ends with the document that reaches so many ids.
FILE_IDS = 4_000_000
#: Set bits of each byte.
ONES = np.array([bin(i).count("1") for i in range(256)], "<u8")


def dac_bytes(ids: np.ndarray, doc_ids: np.ndarray, present: np.ndarray, starts: np.ndarray) -> bytes:
    """header (magic, ids, documents, levels), doc_ids, their presence, starts (documents + 1), then for every level: chunks, bitmap, ranks."""
    levels, rest = [], ids.astype("<u4")
    while True:
        chunk, more = (rest & ((1 << BITS) - 1)).astype("u1"), rest >> BITS
        going = more > 0
        bitmap = np.packbits(going, bitorder="little")
        bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % (RANK_BLOCK // 8), "u1")])
        blocks = ONES[bitmap].reshape(-1, RANK_BLOCK // 8).sum(axis=1) if len(bitmap) else np.zeros(0, "<u8")
        levels.append((chunk, bitmap, np.concatenate([[0], np.cumsum(blocks)]).astype("<u4")))
        if not going.any():
            break
        rest = more[going]
    head = MAGIC + struct.pack("<QQQ", len(ids), len(doc_ids), len(levels))
    body = [doc_ids.astype("<i8").tobytes(), present.astype("u1").tobytes(), starts.astype("<u8").tobytes()]
    for chunk, bitmap, ranks in levels:
        body += [struct.pack("<QQQ", len(chunk), len(bitmap), len(ranks)), chunk.tobytes(), bitmap.tobytes(), ranks.tobytes()]
    return head + b"".join(body)


class Reader:
    """One file: single tokens by ``get``, the ids of a run of tokens by ``run``."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a file of token ids")
        self.n, n_docs, n_levels = struct.unpack_from("<QQQ", data, 8)
        at = 32
        self.doc_ids, at = np.frombuffer(data, "<i8", n_docs, at), at + 8 * n_docs
        self.present, at = np.frombuffer(data, "u1", n_docs, at), at + n_docs
        self.starts, at = np.frombuffer(data, "<u8", n_docs + 1, at), at + 8 * (n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            a, b, c = struct.unpack_from("<QQQ", data, at)
            at += 24
            self.levels.append((np.frombuffer(data, "u1", a, at), np.frombuffer(data, "u1", b, at + a), np.frombuffer(data, "<u4", c, at + a + b)))
            at += a + b + 4 * c

    def rank(self, level: int, i: int) -> int:
        """Ids among the first i of a level that go on to the next."""
        _, bitmap, ranks = self.levels[level]
        block = i // RANK_BLOCK
        first, last = block * RANK_BLOCK // 8, i // 8
        got = int(ranks[block]) + int(ONES[bitmap[first:last]].sum())
        return got + (int(ONES[bitmap[last] & ((1 << i % 8) - 1)]) if i % 8 else 0)

    def get(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, (chunk, bitmap, _) in enumerate(self.levels):
            value |= int(chunk[i]) << (BITS * k)
            if not bitmap[i // 8] >> (i % 8) & 1:
                return value
            i = self.rank(k, i)
        return value

    def run(self, first: int, last: int) -> np.ndarray:
        """The ids from first to before last: the ids of a run that go on stand together in the next level."""
        out, at, a, b = np.zeros(last - first, "<u4"), np.arange(last - first), first, last
        for k, (chunk, bitmap, _) in enumerate(self.levels):
            out[at] |= chunk[a:b].astype("<u4") << np.uint32(BITS * k)
            going = np.unpackbits(bitmap[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a].astype(bool)
            at = at[going]
            if not len(at):
                break
            a = self.rank(k, a)
            b = a + len(at)
        return out


def written(path: str, folder: str, end_id: int | None):
    """Encodes the documents of a task in their order, writes files and returns a row for each. Every attempt has names of its own; only the rows of the one that counts name files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, fs, root = words_of(path), *pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        part, seq, end = TaskContext.get().partitionId(), 0, b"" if end_id is None else struct.pack("<I", end_id)
        docs: list = []
        codes: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, codes, size, seq
            sizes = np.array([len(c) // 4 for c in codes], "<u8")
            present = np.array([d is not None for d in docs], "u1")
            data = dac_bytes(np.frombuffer(b"".join(codes), "<u4"), np.array([d or 0 for d in docs], "<i8"), present, np.concatenate([[0], np.cumsum(sizes)]))
            name = f"ids-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.dac"
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            row = pa.record_batch([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([name]), pa.array([len(docs)], pa.int64()), pa.array([int(sizes.sum())], pa.int64())],
                                  ["part", "seq", "name", "n_docs", "n_ids"])
            docs, codes, size, seq = [], [], 0, seq + 1
            return row

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                docs.append(doc_id)
                codes.append(words.text_ids(text or "") + end)
                size += len(codes[-1]) // 4
                if size >= FILE_IDS:
                    yield flush()
        if docs:
            yield flush()
    return run


def write_ids(docs: DataFrame, path: str, folder: str, text: str = "text", id_col: str = "doc_id", end_id: int | None = 1) -> DataFrame:
    """Writes the ids of every whole text, in ascending order of doc_id over all files, and returns the files: name, start (ids before it), n_docs, n_ids.

    Null texts count as empty; rows without an id come first, rows with the same id in the order of a hash of the text; ``end_id`` closes
    every document; other columns are not read; no rows give no files. The tokenizer file must be one that drops white space.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    files = stored(ranged.mapInArrow(written(path, folder, end_id), "part int, seq int, name string, n_docs long, n_ids long"), "ids-files")
    # one row for each four million ids
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).select("name", "start", "n_docs", "n_ids")


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files; a task for each file or so. No files give no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with fs.open_input_file(f"{root}/{name}") as source:
                    r = Reader(source.read())
                edges = r.starts.astype("<i8")
                crcs = [zlib.crc32(r.run(int(i), int(j)).tobytes()) for i, j in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.record_batch([pa.array(r.doc_ids, mask=r.present == 0), pa.array(edges[:-1] + start), pa.array(np.diff(edges)), pa.array(crcs, pa.int64())],
                                      ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = max(1, files.count())  # a number that is given is not folded: each file is opened by a task of its own, but for hash ties
    return files.select("name", "start").repartition(tasks, "name").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query("op7_addressable_codes")
def op7_addressable_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = shared_path(spark, "token-ids")
    return read_ids(write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder), folder)
