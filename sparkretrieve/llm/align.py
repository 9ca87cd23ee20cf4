"""Alignment of two tokenizers' tokens over the same texts.

Tokenizer A is a byte-level BPE of the ``tokenizers`` library and encodes a
space and the text; tokenizer B is a ``sentencepiece`` model, which puts that
space there itself. Both libraries report spans: character offsets for A,
spans of the result proto for B. These are *coarse cuts*: a token that ends
where no neighbour shares its last character ends there. Tokens that share a
character (several byte-level tokens of one letter, byte-fallback pieces, the
added space) are refined by their decoded bytes.

Byte offsets where tokens of both end cut the tokens into *groups*; the two
tokens that end there are a *link*.

A space between two visible characters always begins a token of both
tokenizers, so texts are cut there into segments, and a Python worker keeps the
groups of up to ``CACHE_SEGMENTS`` distinct segments. That also bounds what one
library call holds, whatever the length of the text.

How often an id pair is linked is counted over all documents in Spark. The
distinct pairs (never more than the product of the two vocabularies) are
looked up in sorted blocks of at most ``PAIRS_PER_BLOCK`` rows, each broadcast
on its own; several blocks mean several passes over the documents' pairs,
whose sums are then added up by row.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretrieve.llm.bpe import byte_letters
from sparkretrieve.llm.common import Shared, free_name, map_batches, materialise, process_cache

CACHE_SEGMENTS = 400_000
PAIRS_PER_BLOCK = 2_000_000
# How many new segments go to the libraries in one call, how many segments
# wait for one look-up, and how many characters of text are cut at a time.
CALL_SEGMENTS = 2048
WAITING_SEGMENTS = 40_000
SLICE = 1 << 18

_VISIBLE = "!-~À-ÖØ-öø-ÿ"
_JOINABLE = re.compile(f"[{_VISIBLE}](?s:.*[{_VISIBLE}])?")
_BORDER = re.compile(f"(?<=[{_VISIBLE}]) (?=[{_VISIBLE}])")


def token_ends(coarse: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte end of each token of a text from its coarse end and the size of its
    decoded bytes. A coarse end strictly between its neighbours' is a cut of
    the text; a token whose coarse end a neighbour shares ends where its
    decoded bytes end."""
    decoded = np.cumsum(sizes)
    if not len(coarse):
        return decoded
    rises = coarse[:-1] < coarse[1:]
    own = np.append(True, rises) & np.append(rises, True) & (coarse == decoded)
    return np.where(own, coarse, decoded)


def _byte_ends(text: str) -> np.ndarray:
    """The byte at which the first k characters of a text end, for each k."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.append(0, np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)))


class Aligner:
    """The two tokenizers and the groups of the segments seen so far. A
    segment's entry is (n_a, n_b, groups, pairs, ends) or None where the
    joined token bytes of A or B are not a space and the segment; pairs and
    ends are packed, eight bytes each."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        with open(a_path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in letters for c in token):
                self.bytes_a[i] = bytes(letters[c] for c in token)
        self.bytes_b = [self._piece_bytes(i) for i in range(self.b.get_piece_size())]
        if any(" " in p.decode("utf-8", "replace").lstrip(" ") for p in self.bytes_b if len(p) > 1):
            raise ValueError("pieces of the second tokenizer must not cross a space")
        # The ids as text, with what follows them in a group's notation.
        n = max(len(self.bytes_a), len(self.bytes_b))
        self.inside, self.between, self.behind, self.plain = (
            np.asarray([f"{i}{mark}" for i in range(n)], object) for mark in (",", "|", ";", ""))
        self.size_a, self.size_b = (np.asarray([len(t) for t in table]) for table in (self.bytes_a, self.bytes_b))
        # What was used lately, and what was used before that.
        self.known: dict[str, tuple | None] = {}
        self.before: dict[str, tuple | None] = {}

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode("utf-8")

    def _proto(self, text: str):
        """The result proto of a text; older versions call it immutable."""
        try:
            return self.b.encode(text, return_type="proto")
        except TypeError:
            return self.b.encode(text, out_type="immutable_proto")

    def learn(self, segments: list[str]) -> None:
        """Have entries for all of ``segments`` in ``known``."""
        new = []
        for s in dict.fromkeys(segments):
            if s not in self.known:
                if s in self.before:
                    self.known[s] = self.before.pop(s)
                else:
                    new.append(s)
        # Segments between visible characters can be encoded in one text.
        joined = [s for s in new if _JOINABLE.fullmatch(s)]
        for k in range(0, len(joined), CALL_SEGMENTS):
            part = joined[k:k + CALL_SEGMENTS]
            self.known.update(zip(part, self._align(part), strict=True))
        for s in new:
            if s not in self.known:
                self.known[s] = self._align([s])[0]

    def forget(self) -> None:
        """Keep to ``CACHE_SEGMENTS``: what was not used since the last time goes."""
        if len(self.known) > CACHE_SEGMENTS // 2:
            self.known, self.before = {}, self.known

    def _align(self, segments: list[str]) -> list[tuple | None]:
        text = " ".join(segments)
        spaced = " " + text
        raw = spaced.encode("utf-8")
        enc, pieces = self.a.encode(spaced, add_special_tokens=False), self._proto(text).pieces
        ids_a, ids_b = enc.ids, [p.id for p in pieces]
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != raw or b"".join(map(self.bytes_b.__getitem__, ids_b)) != raw:
            if len(segments) == 1:
                return [None]
            half = len(segments) // 2
            return self._align(segments[:half]) + self._align(segments[half:])
        coarse_a, coarse_b = np.asarray([e for _, e in enc.offsets], np.int64), np.asarray([p.end for p in pieces], np.int64) + 1
        if len(raw) != len(spaced):
            byte_end = _byte_ends(spaced)
            coarse_a = byte_end[coarse_a]
            if len(coarse_b) and coarse_b[-1] != len(raw):  # spans of older versions count characters, too
                coarse_b = byte_end[coarse_b]
        ids_a, ids_b = np.asarray(ids_a, np.int64), np.asarray(ids_b, np.int64)
        at, in_a, in_b = np.intersect1d(token_ends(coarse_a, self.size_a[ids_a]), token_ends(coarse_b, self.size_b[ids_b]),
                                        assume_unique=True, return_indices=True)
        # Token t of a group stands behind all tokens of the groups before and,
        # where it is B's, behind the group's A tokens.
        size_a, size_b = np.diff(in_a, prepend=-1), np.diff(in_b, prepend=-1)
        length = np.fromiter((len(s.encode("utf-8")) + 1 for s in segments), np.int64, len(segments))
        stops = np.cumsum(length)
        end = np.searchsorted(at, stops, side="right")  # groups up to and with each segment
        notes = np.empty(len(ids_a) + len(ids_b), object)
        notes[np.arange(len(ids_a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)] = self.inside[ids_a]
        notes[np.arange(len(ids_b)) + np.repeat(np.cumsum(size_a), size_b)] = self.inside[ids_b]
        last_a, last_b = ids_a[in_a], ids_b[in_b]
        notes[in_a + np.cumsum(size_b) - size_b] = self.between[last_a]
        marks = self.behind[last_b]
        marks[end - 1] = self.plain[last_b[end - 1]]
        notes[in_b + np.cumsum(size_a)] = marks
        notes, pairs = notes.tolist(), (last_a << 32 | last_b).astype("<i8").tobytes()
        at = (at - np.repeat(stops - length, np.diff(end, prepend=0))).astype("<i8").tobytes()
        found, t, g = [], 0, 0
        for n_a, n_b, stop in zip(np.diff(in_a[end - 1], prepend=-1).tolist(), np.diff(in_b[end - 1], prepend=-1).tolist(),
                                  (8 * end).tolist(), strict=True):
            found.append((n_a, n_b, "".join(notes[t:t + n_a + n_b]), pairs[g:stop], at[g:stop]))
            t, g = t + n_a + n_b, stop
        return found


class _Document:
    """The sum of a text's segments; none of them if one has no entry."""

    def __init__(self, spans: bool) -> None:
        self.spans, self.good, self.n_a, self.n_b, self.shift = spans, True, 0, 0, 0
        self.groups: list[str] = []
        self.pairs: list[bytes] = []
        self.ends: list[np.ndarray] = []

    def add(self, entries: list[tuple | None]) -> None:
        self.good = self.good and None not in entries
        if not self.good or not entries:
            return
        n_a, n_b, groups, pairs, ends = zip(*entries, strict=True)
        self.n_a += sum(n_a)
        self.n_b += sum(n_b)
        self.groups.append(";".join(groups))
        self.pairs.append(b"".join(pairs))
        if self.spans:
            for e in ends:
                self.ends.append(np.frombuffer(e, "<i8") + self.shift)
                self.shift = int(self.ends[-1][-1])

    def row(self) -> dict:
        if not self.good:
            self.__init__(self.spans)
        pairs, n = np.unique(np.frombuffer(b"".join(self.pairs), "<i8"), return_counts=True)
        return {"n_a": self.n_a, "n_b": self.n_b, "n_groups": int(n.sum()), "groups": ";".join(self.groups),
                "pairs": pairs, "pair_n": n, "ends": np.concatenate(self.ends) if self.ends else np.zeros(0, np.int64)}


def align_texts(aligner: Aligner, texts: list[str | None], spans: bool = False) -> list[dict]:
    """One row of results per text."""
    documents = [_Document(spans) for _ in texts]
    waiting: list[tuple[int, list[str]]] = []
    size = 0

    def settle() -> None:
        aligner.learn(list(chain.from_iterable(s for _, s in waiting)))
        for i, segments in waiting:
            documents[i].add(list(map(aligner.known.__getitem__, segments)))
        waiting.clear()
        aligner.forget()

    for i, text in enumerate(texts):
        for segments in _slices(text or ""):
            waiting.append((i, segments))
            size += len(segments)
            if size > WAITING_SEGMENTS:
                settle()
                size = 0
    settle()
    return [d.row() for d in documents]


def _slices(text: str) -> Iterator[list[str]]:
    """The segments of a text, some ``SLICE`` characters at a time."""
    at = 0
    while at < len(text):
        border = _BORDER.search(text, at + SLICE) if len(text) - at > SLICE else None
        stop = border.start() if border else len(text)
        yield _BORDER.split(text[at:stop])
        at = stop + 1 if border else stop


def token_groups(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", spans: bool = False) -> DataFrame:
    """``docs`` without its text, with n_a, n_b (tokens), n_groups (long),
    groups (string: ``a1,a2|b1;a3|b2,b3``, ids in order), pairs (array<long>:
    the distinct links, A id * 2^32 + B id), pair_n (array<int>: how often the
    document has each) and, with ``spans``, ends (array<int>: the byte after
    each group, in the space and text).

    Null and empty texts, and texts whose joined token bytes are not a space
    and the text, have no tokens: zeros and an empty string. Rows stay as they
    are otherwise, repeated ones too; columns named like a result are
    replaced; an empty table gives an empty result."""
    added = {"n_a": "long", "n_b": "long", "n_groups": "long", "groups": "string", "pairs": "array<long>", "pair_n": "array<int>"}
    added |= {"ends": "array<int>"} if spans else {}
    taken = {c.lower() for c in added} | {text_col.lower()}
    kept = [f for f in docs.schema if f.name.lower() not in taken]
    text = free_name(docs, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        aligner = process_cache("align", (a_path, b_path), lambda: Aligner(a_path, b_path))
        for batch in batches:
            cols: dict[str, list] = {c: [] for c in added}
            for row in align_texts(aligner, batch.column(batch.num_columns - 1).to_pylist(), spans):
                for c, values in cols.items():
                    values.append(row[c])
            yield {f.name: batch.column(i) for i, f in enumerate(kept)} | cols

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {t}" for n, t in added.items()]
    read = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`").alias(text))
    return map_batches(read, ", ".join(fields), run, rows_per_batch=512)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of all documents hold each id pair, and
    whether no pair of the same B id has more. Counts are added up within each
    task before they are shuffled, so a frequent pair is no hot key."""
    each = aligned.select(F.explode_outer(F.arrays_zip("pairs", "pair_n")).alias("p")) \
        .filter("p is not null").select("p.pairs", "p.pair_n")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_n").alias("n")) \
        .withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    counts = materialise(counts, "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _look_up(aligned: DataFrame, kept: list[str], block: Shared) -> DataFrame:
    """``kept`` columns of ``aligned`` with n_links, n_best and count_sum over
    the pairs of one block (n_links over all pairs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        keys, counts, best = block.value
        for batch in batches:
            at = batch.schema.get_field_index
            lists, n = batch.column(at("pairs")), batch.column(at("pair_n")).flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            pair = lists.flatten().to_numpy(zero_copy_only=False)
            n = n.astype(np.int64)
            total, sums, firsts = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            np.add.at(total, row, n)
            if len(keys):
                place = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
                there = keys[place] == pair
                np.add.at(sums, row[there], n[there] * counts[place[there]])
                there &= best[place]
                np.add.at(firsts, row[there], n[there])
            yield {c: batch.column(at(c)) for c in kept} | {"n_links": total, "n_best": firsts, "count_sum": sums}

    fields = [f"`{c}` {aligned.schema[c].dataType.simpleString()}" for c in kept]
    return map_batches(aligned.select(*kept, "pairs", "pair_n"),
                       ", ".join([*fields, "n_links long", "n_best long", "count_sum long"]), run)


def score_links(aligned: DataFrame, pairs_per_block: int = PAIRS_PER_BLOCK) -> DataFrame:
    """The rows of ``token_groups`` without pairs and pair_n, and with n_links,
    n_best (links whose pair is as frequent as any of its B id) and count_sum
    (the pair's count, summed over links). Written once, as it is read twice."""
    spark = aligned.sparkSession
    row = free_name(aligned, "_row")
    aligned = aligned.drop("n_links", "n_best", "count_sum")
    written = materialise(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
    counts = materialise(link_counts(written), "links")
    blocks = max(1, -(-counts.count() // pairs_per_block))
    kept = [c for c in aligned.columns if c not in ("pairs", "pair_n")]
    parts = []
    for k in range(blocks):
        mine = counts.filter(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == k).toArrow()
        order = np.argsort(keys := mine["pair"].to_numpy())
        block = Shared(spark, (keys[order], mine["n"].to_numpy()[order], mine["best"].to_numpy()[order].astype(bool)))
        if blocks == 1:
            return _look_up(written, kept, block)
        parts.append(materialise(_look_up(written, [row], block), "link_sums"))
        block.broadcast.destroy()
    sums = parts[0]
    for p in parts[1:]:
        sums = sums.union(p)
    sums = sums.groupBy(row).agg(F.max("n_links").alias("n_links"), F.sum("n_best").alias("n_best"),
                                 F.sum("count_sum").alias("count_sum"))
    return written.select(*kept, row).join(sums, row).drop(row)
