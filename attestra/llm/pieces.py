"""SentencePiece encoding and decoding by vectorised merge rounds (operator 11).

A task cuts texts into words that no piece of the model crosses and numbers its distinct words. New words become one flat symbol array: each
round looks up the least pair rank of every word, merges all leftmost pairs of that rank at once and compacts the array, until no word has a
pair left. Documents are then filled in from the words' codes. Nothing is shuffled; the words a task knows are bounded and then learned anew.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.llm.common import query, table

SPACE = "▁"
#: Latin letters: where no piece joins one with another sign, texts are also cut between the two.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Words and characters that a worker remembers before it starts anew, and word places or ids that it holds at a time.
KEEP_WORDS, KEEP_CHARS, BATCH = 300_000, 6_000_000, 300_000
#: Symbols from which a word is merged alone with a heap: rounds over it would each pass the whole word.
LONG = 4096
NO_PAIR = np.int32(np.iinfo(np.int32).max)


class Numbers(dict):
    """word -> number in order of arrival; ``new`` has the words that are not coded yet."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.chars = 0

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        self.chars += len(word)
        return number


class Model:
    """A byte-pair model with byte fallback, as arrays. Symbols are piece ids, then the pieces' characters that are no piece, then code points."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE or not proto.trainer_spec.byte_fallback or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("only byte-pair models with byte fallback and without user-defined or unused pieces")
        norm = proto.normalizer_spec
        self.plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not proto.trainer_spec.treat_whitespace_as_suffix
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.size = len(proto.pieces)
        self.special = np.array([p.type != kinds.NORMAL for p in proto.pieces])
        self.byte_ids = np.array([self.processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)], "<u4")
        as_bytes = {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}
        self.texts = [as_bytes.get(i, b"" if p.type == kinds.CONTROL else p.piece.replace(SPACE, " ").encode()) for i, p in enumerate(proto.pieces)]
        self.decimal = [b"%d," % i for i in range(self.size)]
        # equal scores have equal rank: the leftmost of them goes first, whatever the piece
        scores = np.array([proto.pieces[i].score for i in normal.values()], "<f4")
        rank = dict(zip(normal, np.unique(-scores, return_inverse=True)[1].astype("<i4"), strict=True))
        symbols = dict(normal)
        for c in sorted({c for p in normal for c in p} - set(normal)):
            symbols[c] = self.size + len(symbols) - len(normal)
        self.codes = self.size + len(symbols) - len(normal)  # a code point c without a symbol is codes + c
        self.first = np.arange(0x110000, dtype="<i8") + self.codes
        for c, s in symbols.items():
            if len(c) == 1:
                self.first[ord(c)] = s
        self.chars = {s: c for c, s in symbols.items() if s >= self.size}
        pairs = {}
        hazard = np.zeros(self.codes, bool)
        for piece, i in normal.items():
            for k in range(1, len(piece)):
                left, right = symbols.get(piece[:k]), symbols.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left * self.codes + right] = i
                    # a piece that can go on into one of no worse rank: the pairs right of it have to wait
                    for part in (piece[:k], piece[k:]):
                        hazard[symbols[part]] |= part in rank and rank[piece] <= rank[part]
        self.hazard = hazard
        self.keys = np.array(sorted(pairs), "<i8")
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], "<i8")
        piece_rank = np.zeros(self.size, "<i4")
        for piece, i in normal.items():
            piece_rank[i] = rank[piece]
        self.ranks = piece_rank[self.merged]
        crossing = {a + b for p in normal for a, b in pairwise(p)}
        spaces_lead = not any(b == SPACE != a for a, b in crossing)
        letter = re.compile(f"[{LETTERS}]")
        own = not any(bool(letter.match(a)) != bool(letter.match(b)) and SPACE != a for a, b in crossing)
        self.cut = re.compile(f" *[{LETTERS}]+| *[^ {LETTERS}]+| +" if own and spaces_lead else " *[^ ]+| +" if spaces_lead else "(?s:.+)")

    def words(self, text: str) -> list[str]:
        """Words (blanks for the model's space sign) whose codes, one after the other, are the codes of the text."""
        if not text:
            return []
        text = (" " + text if self.plain else self.processor.normalize(text)).replace(SPACE, " ")
        return self.cut.findall(text)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; ``NO_PAIR`` where no piece is the two together."""
        at = np.where((left < self.codes) & (right < self.codes), left * self.codes + right, -1)
        place = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        hit = self.keys[place] == at
        return np.where(hit, self.ranks[place], NO_PAIR), np.where(hit, self.merged[place], -1)

    def rounds(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words one after the other, and how many each word has."""
        joined = "".join(words).replace(" ", SPACE)
        symbol = self.first[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")]
        sizes = np.fromiter(map(len, words), "<i8", len(words))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        word = np.repeat(np.arange(len(words)), sizes)
        for i in np.flatnonzero(sizes > LONG):
            alone = self.alone(symbol[word == i].tolist())
            done.append((np.array(alone, "<i8"), np.full(len(alone), i)))
        if done:
            short = sizes[word] <= LONG
            symbol, word = symbol[short], word[short]
        rank = np.full(len(symbol), NO_PAIR)
        into = np.full(len(symbol), -1, "<i8")
        stale = np.arange(len(symbol))  # places whose pair with the next symbol is to be looked up
        while len(symbol):
            stale = stale[stale < len(symbol) - 1]
            stale = stale[word[stale] == word[stale + 1]]
            rank[stale], into[stale] = self.pairs(symbol[stale], symbol[stale + 1])
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            counts = np.diff(np.append(starts, len(word)))
            least = np.minimum.reduceat(rank, starts)
            open_word = least < NO_PAIR
            if not open_word.all():  # words without a pair leave
                stay = np.repeat(open_word, counts)
                done.append((symbol[~stay], word[~stay]))
                symbol, word, rank, into = symbol[stay], word[stay], rank[stay], into[stay]
                counts, least = counts[open_word], least[open_word]
                starts = np.cumsum(counts) - counts
                if not len(symbol):
                    break
            best = rank == np.repeat(least, counts)
            at = np.flatnonzero(best)
            # of pairs that overlap, every second from the left
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
            number = np.repeat(np.arange(len(starts)), counts)[at]
            head = np.diff(number, prepend=-1) != 0
            waits = np.zeros(len(starts), bool)
            np.logical_or.at(waits, number, self.hazard[into[at]])
            at = at[head | ~waits[number]]
            symbol[at] = into[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            rank[at], into[at] = NO_PAIR, -1
            before = at[at > 0] - 1
            rank[before], into[before] = NO_PAIR, -1
            moved = np.cumsum(keep) - 1
            here = moved[at]
            symbol, word, rank, into = symbol[keep], word[keep], rank[keep], into[keep]
            touched = np.zeros(len(symbol), bool)
            touched[here] = touched[here[here > 0] - 1] = True
            stale = np.flatnonzero(touched)
        flat = np.concatenate([s for s, _ in done]) if done else symbol
        owner = np.concatenate([w for _, w in done]) if done else word
        order = np.argsort(owner, kind="stable")
        return flat[order], np.bincount(owner, minlength=len(words))

    def alone(self, symbols: list[int]) -> list[int]:
        """One long word: a heap of pairs by rank, then place."""
        n = len(symbols)
        known = self.lookup()
        after, before = list(range(1, n)) + [-1], list(range(-1, n - 1))
        heap = []

        def push(i: int, j: int) -> None:
            got = known.get(symbols[i] * self.codes + symbols[j]) if symbols[i] < self.codes and symbols[j] < self.codes else None
            if got is not None:
                heapq.heappush(heap, (got[0], i, symbols[i], symbols[j], got[1]))

        for i in range(n - 1):
            push(i, i + 1)
        while heap:
            _, i, left, right, into = heapq.heappop(heap)
            j = after[i] if symbols[i] == left else -1
            if j < 0 or symbols[j] != right:
                continue
            symbols[i], symbols[j] = into, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                push(i, after[j])
            if before[i] >= 0:
                push(before[i], i)
        return [s for s in symbols if s >= 0]

    @lru_cache(maxsize=1)  # noqa: B019
    def lookup(self) -> dict[int, tuple[int, int]]:
        return {k: (r, m) for k, r, m in zip(self.keys.tolist(), self.ranks.tolist(), self.merged.tolist(), strict=True)}

    def code(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each word has. A character without a piece becomes its bytes."""
        symbol, counts = self.rounds(words)
        other = np.flatnonzero(symbol >= self.size)
        if not len(other):
            return symbol.astype("<u4"), counts
        spelled = [self.byte_ids[list(self.chars[s].encode() if s < self.codes else chr(s - self.codes).encode("utf-8", "surrogatepass"))] for s in symbol[other].tolist()]
        width = np.ones(len(symbol), "<i8")
        width[other] = [len(x) for x in spelled]
        out = np.repeat(np.where(symbol < self.size, symbol, 0), width).astype("<u4")
        ends = np.cumsum(width)
        for i, x in zip(other.tolist(), spelled, strict=True):
            out[ends[i] - len(x):ends[i]] = x
        return out, np.bincount(np.repeat(np.arange(len(counts)), counts), width, len(counts)).astype("<i8")


@lru_cache(maxsize=2)
def model_of(path: str) -> Model:
    return Model(path)


class Coder:
    """The words of one worker and their codes."""

    def __init__(self, model: Model):
        self.model = model
        self.start_anew()

    def start_anew(self) -> None:
        self.numbers = Numbers()
        self.flat, self.starts, self.sizes = np.zeros(0, "<u4"), np.zeros(0, "<i8"), np.zeros(0, "<i8")
        self.decimal: list[bytes] = []

    def learn(self) -> None:
        if not self.numbers.new:
            return
        ids, counts = self.model.code(self.numbers.new)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.sizes = np.concatenate([self.sizes, counts])
        self.flat = np.concatenate([self.flat, ids])
        digits, at = self.model.decimal, 0
        listed = ids.tolist()
        for n in counts.tolist():
            self.decimal.append(b"".join([digits[i] for i in listed[at:at + n]]))
            at += n
        self.numbers.new = []

    def full(self) -> bool:
        return len(self.numbers) > KEEP_WORDS or self.numbers.chars > KEEP_CHARS


def coded(path: str):
    """doc_id, ids, ids_sha256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(model_of(path))
        for b in batches:
            first, places, held = 0, [], 0
            for i in range(b.num_rows):
                words = coder.model.words(b.column(1)[i].as_py() or "")
                places.append(np.fromiter(map(coder.numbers.__getitem__, words), "<i4", len(words)))
                held += len(words)
                if held >= BATCH or i == b.num_rows - 1:
                    coder.learn()
                    yield filled(coder, b.column(0).slice(first, i + 1 - first), places)
                    first, places, held = i + 1, [], 0
                    if coder.full():
                        coder.start_anew()
    return run


def filled(coder: Coder, ids: pa.Array, places: list[np.ndarray]) -> pa.RecordBatch:
    decimal = coder.decimal
    shas = [hashlib.sha256(b"".join([decimal[k] for k in p.tolist()])[:-1]).hexdigest() for p in places]
    at = np.concatenate(places)
    n = coder.sizes[at]
    offsets = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum([len(p) for p in places])])]
    values = coder.flat[np.repeat(coder.starts[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    return pa.record_batch([ids, pa.ListArray.from_arrays(pa.array(offsets.astype("<i4")), pa.array(values.astype("<i4"))), pa.array(shas, pa.string())], ["doc_id", "ids", "ids_sha256"])


def encode(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, ids (array<int>) and ids_sha256 (of the decimal ids joined by commas) of every row, as the sentencepiece library encodes the
    whole text without begin or end ids and without sampling.

    Null and empty texts have no ids; null, repeated and tied ids are rows of their own; ids may be of any type; other columns are not read;
    no rows give no rows. Texts of any length are whole; a word of more than 4,096 characters is merged alone.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(coded(path), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, ids_sha256 string")


def piece_texts(model: Model, pieces: pa.Array, column: pa.ListArray) -> list[str]:
    """Texts of rows of ids: pieces joined, the first blank dropped; rows with bytes that are no UTF-8 or with unusual beginnings go to the library."""
    offsets = column.offsets.to_numpy().astype("<i8")
    offsets = offsets - offsets[0]
    values = column.flatten()
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), pieces.take(values)), pa.scalar(b"", pa.large_binary()))
    out = []
    for i, data in enumerate(joined):
        if offsets[i] == offsets[i + 1]:
            out.append("")
            continue
        whole = data.as_py()
        own = model.plain and not model.special[values[offsets[i]].as_py()]
        try:
            out.append((whole[1:] if whole[:1] == b" " else whole).decode() if own else model.processor.decode(values[offsets[i]:offsets[i + 1]].to_pylist()))
        except UnicodeDecodeError:
            out.append(model.processor.decode(values[offsets[i]:offsets[i + 1]].to_pylist()))
    return out


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for, as the library's decode does. Null ids give an empty text; an id outside the vocabulary stops the job."""
    schema = encoded.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    at, names = encoded.columns.index(ids), [*encoded.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        pieces = pa.array(model.texts, pa.large_binary())
        for b in batches:
            column = b.column(at)
            if column.null_count:
                column = pc.if_else(column.is_null(), pa.scalar([], column.type), column)
            ends, first = column.offsets.to_numpy(), 0
            while first < len(column):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + BATCH, "right")) - 1)
                texts = piece_texts(model, pieces, column.slice(first, last - first))
                yield pa.record_batch([*b.slice(first, last - first).columns, pa.array(texts, pa.string())], names)
                first = last

    return encoded.mapInArrow(run, f"{schema}, {name} string")


@query("op11_merge_rounds")
def op11_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    done = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
