"""Byte-level BPE encoding and decoding with a contiguous rank array.

A pre-token ("word") of n bytes is held as its part boundaries and, beside
them, the rank of the merge of each part with its right neighbour. The merge
loop scans for the smallest rank, deletes the boundary between the two parts,
and refreshes the two neighbouring ranks. Words are short, so the scan over a
contiguous array beats any heap; words above ``LONG_WORD`` bytes (a run of one
letter may fill a whole document) use a heap over linked parts, with the same
ties (smallest rank, then leftmost), so that no text takes quadratic time.

The vocabulary file is a parameter (a path that every executor can read) and
is loaded once per Python worker; a worker also remembers the ids of up to
``CACHE_WORDS`` distinct words.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator
from itertools import chain
from typing import Any

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sparkretrieve.llm.common import map_batches, process_cache

LONG_WORD = 256
CACHE_WORDS = 400_000
NONE = 1 << 60

# How text is split into words before the merges, as the public
# vocabulary's format states it; \s is Unicode white space.
WORD_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

# The same split for texts of Latin letters and common punctuation only, as
# plain ranges for the standard library's faster engine.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ʯ", "0-9²³¹¼-¾", "\t-\r \x85\xa0  "
_LATIN_PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+"
                  rf"|[{_S}]+(?![^{_S}])|[{_S}]+")
_NOT_LATIN = re.compile("[^\x00-ʯ‐- €]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the rest for U+0100 onwards."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    return letters


class BpeCodec:
    """A vocabulary, and the encoding and decoding of single texts."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.id_of = vocab
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        # The rank of a merge by its two parts; no file has a pair twice.
        self.rank = {(bytes(letters[c] for c in a), bytes(letters[c] for c in b)): r
                     for r, (a, b) in enumerate(merges)}
        self.bytes_of = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode("utf-8") for t, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.words = regex.compile(WORD_PATTERN)
        self.latin_words = re.compile(_LATIN_PATTERN)
        self.cache = _WordCache(self)

    def encode_word(self, word: bytes) -> list[int]:
        whole = self.id_of.get(word)
        if whole is not None and len(word) == 1:
            return [whole]
        return self._merge_long(word) if len(word) > LONG_WORD else self._merge_short(word)

    def _merge_short(self, word: bytes) -> list[int]:
        parts = [word[i:i + 1] for i in range(len(word))]
        rank = self.rank.get
        ranks = [rank(pair, NONE) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)  # the leftmost of equal ranks
            parts[i] += parts[i + 1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), NONE)
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), NONE)
        return [self.id_of[p] for p in parts]

    def _merge_long(self, word: bytes) -> list[int]:
        n = len(word)
        parts: list[bytes | None] = [word[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank.get
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]), NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            left, j = parts[i], after[i]
            if left is None or j >= n or len(left) + len(parts[j]) != size:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = left + parts[j], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank((parts[a], parts[b]), NONE)) != NONE:
                    heapq.heappush(heap, (r, a, len(parts[a]) + len(parts[b])))
        return [self.id_of[p] for p in parts if p is not None]

    def split(self, text: str) -> list[str]:
        return (self.words if _NOT_LATIN.search(text) else self.latin_words).findall(text)

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text; the strings of special tokens become their ids."""
        look_up = self.cache.__getitem__
        if self.special_pattern is None or not self.special_pattern.search(text):
            return list(chain.from_iterable(map(look_up, self.split(text))))
        ids: list[int] = []
        for piece in self.special_pattern.split(text):
            if piece in self.special:
                ids.append(self.special[piece])
            else:
                ids.extend(chain.from_iterable(map(look_up, self.split(piece))))
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class _WordCache(dict):
    """The ids of a word, computed when first asked for."""

    def __init__(self, codec: BpeCodec) -> None:
        super().__init__()
        self.codec = codec

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = tuple(self.codec.encode_word(word.encode("utf-8")))
        if len(self) < CACHE_WORDS and len(word) <= 64:
            self[word] = ids
        return ids


def codec(path: str) -> BpeCodec:
    return process_cache("bpe", path, lambda: BpeCodec(path))


def _mapped(df: DataFrame, column: str, added: dict[str, str], fn: Callable[[BpeCodec, Any], tuple], path: str,
            drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without ``drop`` and with the columns ``added`` (name: type),
    which ``fn`` makes of the codec and the value of ``column``."""
    kept = [f for f in df.schema if f.name.lower() not in {a.lower() for a in added} | {d.lower() for d in drop}]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = codec(path)
        for batch in batches:
            rows = [fn(bpe, v) for v in batch.column(column).to_pylist()]
            values = list(zip(*rows, strict=True)) or [[] for _ in added]
            yield {n: batch.column(n) for n in names} | dict(zip(added, map(list, values), strict=True))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {t}" for n, t in added.items()]
    return map_batches(df, ", ".join(fields), run)


def encode_texts(df: DataFrame, path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with the ids of each whole text (array<int>). A null text counts
    as empty (no ids); a column of the result's name is replaced; rows stay
    as they are otherwise, repeated ones too."""
    return _mapped(df, text_col, {out_col: "array<int>"}, lambda bpe, t: (bpe.encode(t or ""),), path)


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of each list of ids; null counts as no ids."""
    return _mapped(df, ids_col, {out_col: "string"}, lambda bpe, i: (bpe.decode(i or []),), path)


def round_trip_digests(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``df`` without its text, with n_tokens, ids_sha256 (of the decimal ids
    joined by commas) and decoded_sha256: each text is encoded, its ids are
    decoded again, and only digests leave the task."""
    from hashlib import sha256

    def digests(bpe: BpeCodec, text: str | None) -> tuple[int, str, str]:
        ids = bpe.encode(text or "")
        return (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(),
                sha256(bpe.decode(ids).encode("utf-8")).hexdigest())

    added = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return _mapped(df, text_col, added, digests, path, drop=(text_col,))
