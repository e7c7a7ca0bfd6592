"""Word-wise use of a public byte-pair tokenizer file: cuts texts into words that the tokenizer never joins, and encodes words."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Unicode's White_Space: what the tokenizers' patterns call white space.
SPACE = "\t-\r \x85\xa0  -     　"
#: Characters that Python's own white space has beyond it.
EXTRA = re.compile("[\x1c-\x1f]")
#: A blank and what follows it up to the next white space; white space before the last of a run; one white space.
FAST, EXACT = re.compile(r" ?\S+|\s+(?!\S)|\s"), re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")
#: Words whose pieces are known without the tokenizer's pattern: Latin letters, then signs.
PLAIN = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]*)([.,;:!?*$%&#|<>()\[\]{}/\\\"+=~^_`@-]*)")

#: Runs of lower-case Latin-1 texts as a file with the pattern ``FILE_RUNS`` cuts them (no piece spans two runs), so a word has one entry whatever case and signs it comes in.
RUNS = re.compile("'(?:[stmd]|re|ve|ll)|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\\sa-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
FILE_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Known(dict):
    """word -> codes, for up to ``keep`` words: when half as many are in, they become the old ones, from which words still in use come back."""

    def __init__(self, codes: Callable[[str], bytes], keep: int):
        super().__init__()
        self.codes, self.half, self.old = codes, max(1, keep // 2), {}

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        got = self.old.get(word)
        if got is None:
            got = self.codes(word)
        self[word] = got
        return got


class Words:
    """One tokenizer file in one Python worker. ``ids(word)`` is remembered for up to ``keep`` words, those of whole lower-cased texts for three times as many."""

    def __init__(self, path: str, keep: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.known = Known(self.packed, keep)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.lower = self.tokenizer.normalizer is not None
        self.byte = byte_letters()
        self.lowered = Known(self.of_runs, 3 * keep) if self.lower and cuts(self.tokenizer) == FILE_RUNS else None

    def split(self, text: str) -> list[str]:
        """Words whose codes, one after the other, are the codes of the text (byte-level file: blanks belong to the word after them)."""
        pattern = EXACT if EXTRA.search(text) else FAST
        if self.cut is not None and any(s in text for s in self.special):
            return [w for part in self.cut.split(text) for w in ([part] if part in self.special else pattern.findall(part))]
        return pattern.findall(text)

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def pieces(self, word: str) -> list[int]:
        """Codes of one word. Latin words go to the merges directly, all others through the whole tokenizer."""
        return list(struct.unpack(f"<{len(got := self.packed(word)) // 4}I", got))

    def packed(self, word: str) -> bytes:
        """The codes of one word; letters before signs are looked up by themselves, as other words have them too."""
        m = PLAIN.fullmatch(word)
        if m is None or not (m[2] or m[3]):
            got = self.encode(word)
            return struct.pack(f"<{len(got)}I", *got)
        blank, letters, signs = m.groups()
        if self.lower:
            blank, letters = "", letters.lower()
        first = blank + (letters or signs)
        if letters and signs:
            return self.known[first] + self.known[signs]
        if first != word:
            return self.known[first]
        plain = first if first.isascii() and not blank else first.encode().decode("latin-1").translate(self.byte)
        got = [t.id for t in self.model.tokenize(plain)]
        return struct.pack(f"<{len(got)}I", *got)

    def ids(self, word: str) -> bytes:
        """Codes as little-endian unsigned 32-bit integers."""
        return self.known[word]

    def of_runs(self, word: str) -> bytes:
        """The codes of a word of lower-case Latin-1; its runs are looked up by themselves, as other words have them too."""
        runs = RUNS.findall(word)
        if len(runs) > 1:
            return b"".join(map(self.lowered.__getitem__, runs))
        plain = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.byte)
        got = [t.id for t in self.model.tokenize(plain)]
        return struct.pack(f"<{len(got)}I", *got)

    def text_ids(self, text: str) -> bytes:
        """Codes of a whole text for a file that drops white space: the words between white space, each by itself."""
        if EXTRA.search(text) or any(s in text for s in self.special):
            return np.array(self.encode(text), "<u4").tobytes()
        if self.lowered is None:
            return b"".join(map(self.known.__getitem__, text.split()))
        if not wide(text):
            return b"".join(map(self.lowered.__getitem__, text.lower().split()))
        return b"".join(self.known[w] if wide(w) else self.lowered[w.lower()] for w in text.split())


def wide(text: str) -> bool:
    """Whether it has characters beyond Latin-1; below, lower case is a matter of single characters and nothing composes."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return True
    return False


def cuts(tokenizer) -> str | None:
    """The one pattern by which a file cuts lower-cased texts before their bytes are spelled, if that is how it does it."""
    said = json.loads(tokenizer.to_str())
    names = [s.get("type") for s in (said["normalizer"] or {}).get("normalizers") or []]
    steps = (said["pre_tokenizer"] or {}).get("pretokenizers") or []
    if names != ["NFC", "Replace", "Lowercase"] or [s.get("type") for s in steps] != ["Split", "ByteLevel"]:
        return None
    return steps[0]["pattern"].get("Regex") if steps[0].get("invert") and not steps[1].get("use_regex") else None


def byte_letters() -> dict[int, str]:
    """The letter that a byte-level file writes for every byte: printable Latin-1 as it is, the others from U+0100 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def words_of(path: str) -> Words:
    """The worker's own copy; a reused worker keeps what it has learned."""
    return Words(path)


@lru_cache(maxsize=4)
def piece_bytes(path: str) -> list[bytes]:
    """id -> bytes of a byte-level file, added tokens included."""
    tokenizer = words_of(path).tokenizer
    back = {c: b for b, c in byte_letters().items()}
    table: list[bytes] = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for piece, i in tokenizer.get_vocab(with_added_tokens=True).items():
        table[i] = bytes(back[c] for c in piece) if all(c in back for c in piece) else piece.encode()
    return table
