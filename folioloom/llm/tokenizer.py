"""Encoding of texts to the ids of a public byte-level BPE vocabulary.

Method. The distinct pieces of a batch (the split pattern's words) are laid into padded
numpy matrices, one per length bucket. Each round looks up every adjacent pair of every
row in a hashed pair table, merges each row's leftmost pair of minimum rank, and drops
the freed column; rows without a pair left are compacted away. A piece longer than the
widest bucket is a matrix of one row whose rounds merge, from the left, all pairs of the
minimum rank that do not overlap; where that makes a pair of lower rank still, the round
merges the leftmost pair only, so the order of merges that matter stays the same. A
batch's texts are then gathered from the encoded pieces.

Defined results: null and empty texts encode to an empty list; strings that look like
special tokens are ordinary text; every document is encoded whole; a repeated document
counts once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.operators.layout import once

#: Where the public vocabularies are; never copied into the repository.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
#: Widths of the length buckets, in bytes; longer pieces are rows of their own.
BUCKETS = (4, 6, 8, 10, 12, 16, 24, 32, 48, 64, 96, 128, 256)
#: Rows of one matrix, and distinct pieces kept from batch to batch.
MATRIX_ROWS, CACHE_PIECES = 1 << 15, 1 << 19
#: Texts of one Arrow batch.
BATCH_ROWS = 2000

# The public split pattern, with white space spelled out as the Unicode property.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
_NONE = np.int32(np.iinfo(np.int32).max)


class PairTable:
    """(left id, right id) -> merged id, as an open-addressing hash table in numpy."""

    def __init__(self, pairs: dict[tuple[int, int], int]) -> None:
        bits = max(4, int(np.ceil(np.log2(len(pairs) * 2 + 1))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, _NONE, np.int32)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        values = np.array(list(pairs.values()), np.int32)
        at = self._slot(keys)
        waiting = np.arange(len(keys))
        while len(waiting):
            free = self.keys[at[waiting]] == -1
            _, first = np.unique(at[waiting][free], return_index=True)
            placed = waiting[free][first]
            self.keys[at[placed]], self.values[at[placed]] = keys[placed], values[placed]
            waiting = np.setdiff1d(waiting, placed, assume_unique=True)
            at[waiting] = (at[waiting] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids; ``_NONE`` where the pair merges to nothing or an id is padding."""
        shape = left.shape
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        out = np.full(keys.shape, _NONE, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        at = self._slot(keys[todo])
        while len(todo):
            there = self.keys[at]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            on = ~hit & (there != -1)
            todo, at = todo[on], (at[on] + 1) & self.mask
        return out.reshape(shape)


class Vocabulary:
    """Ranks of a public vocabulary, with its pair table and byte ids."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        ranks, pairs = self.ranks, {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        self.table = PairTable(pairs)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece, bucket by bucket."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        low = 0
        for width in BUCKETS:
            chosen = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            for start in range(0, len(chosen), MATRIX_ROWS):
                rows = chosen[start : start + MATRIX_ROWS]
                self._encode_bucket([pieces[k] for k in rows], rows, width, out)
        for k in np.flatnonzero(sizes > low):
            out[k] = self._encode_long(pieces[k])
        return out

    def _encode_bucket(self, pieces: list[bytes], rows: np.ndarray, width: int, out: list[np.ndarray]) -> None:
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.where(np.arange(width)[None, :] < sizes[:, None], self.of_byte[flat], np.int32(-1))
        ranks = self.table.look_up(ids[:, :-1], ids[:, 1:])
        while True:
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            least = ranks[np.arange(len(ids)), at] if ranks.shape[1] else np.full(len(ids), _NONE)
            done = least == _NONE
            if done.any():
                for row, line, size in zip(rows[done], ids[done], sizes[done]):
                    out[row] = line[:size]
                if done.all():
                    return
                stay = ~done
                ids, ranks, rows, sizes, at, least = ids[stay], ranks[stay], rows[stay], sizes[stay], at[stay], least[stay]
            n, w = ids.shape
            here = np.arange(n)
            ids[here, at] = least
            keep = np.ones((n, w), bool)
            keep[here, at + 1] = False
            ids = ids[keep].reshape(n, w - 1)
            keep_ranks = np.ones((n, w - 1), bool)
            keep_ranks[here, at] = False
            ranks = ranks[keep_ranks].reshape(n, w - 2)
            sizes = sizes - 1
            if w - 2:
                left = at > 0
                ranks[here[left], at[left] - 1] = self.table.look_up(ids[here[left], at[left] - 1], ids[here[left], at[left]])
                right = at < w - 2
                ranks[here[right], at[right]] = self.table.look_up(ids[here[right], at[right]], ids[here[right], at[right] + 1])

    def _encode_long(self, piece: bytes) -> np.ndarray:
        """One row wider than the buckets: each round merges all pairs of minimum rank, leftmost first."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)]
        ranks = self.table.look_up(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) != _NONE:
            at = np.flatnonzero(ranks == least)
            # in a run of overlapping pairs every second one merges, from the left
            starts = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            at = at[(np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))) % 2 == 0]
            new_ids, new_ranks, touched = self._merged(ids, ranks, at, least)
            if len(at) > 1 and ((new_ranks[touched] < least).any() or self._meets_lower(ids, at, least)):
                new_ids, new_ranks, _ = self._merged(ids, ranks, at[:1], least)
            ids, ranks = new_ids, new_ranks
        return ids

    def _meets_lower(self, ids: np.ndarray, at: np.ndarray, new: np.int32) -> bool:
        """Whether one of the merges at ``at``, done alone, makes a pair of lower rank with a neighbour."""
        left, right = ids[at[at > 0] - 1], ids[at[at + 2 < len(ids)] + 2]
        ranks = (self.table.look_up(left, np.full_like(left, new)), self.table.look_up(np.full_like(right, new), right))
        return any((r < new).any() for r in ranks)

    def _merged(self, ids: np.ndarray, ranks: np.ndarray, at: np.ndarray, new: np.int32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and ranks of neighbours once the pairs at ``at`` are merged, and the places of the ranks that are new."""
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids = ids.copy()
        ids[at] = new
        ids = ids[keep]
        places = at - np.arange(len(at))
        # the pair at place i starts with id i, so the ranks go with the ids that stay
        ranks = ranks[keep[:-1]][: max(0, len(ids) - 1)]
        touched = np.unique(np.concatenate([places - 1, places]))
        touched = touched[(touched >= 0) & (touched < len(ranks))]
        ranks[touched] = self.table.look_up(ids[touched], ids[touched + 1])
        return ids, ranks, touched


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a rank file, loaded once per worker."""
    return Vocabulary(path)


def _grown(buffer: np.ndarray, size: int) -> np.ndarray:
    """The buffer, or one of twice the size needed with its content."""
    if size <= len(buffer):
        return buffer
    out = np.empty(2 * size, buffer.dtype)
    out[: len(buffer)] = buffer
    return out


class Encoder:
    """Encodes lists of texts; keeps the ids of pieces seen before."""

    def __init__(self, path: str) -> None:
        self.vocabulary = vocabulary(path)
        self.split = regex.compile(_PATTERN).findall
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.filled = np.empty(1 << 16, np.int32), 0
        self.starts = np.empty(1 << 14, np.int64)
        self.sizes = np.empty(1 << 14, np.int64)

    def _keep(self, coded: list[np.ndarray], first: int) -> None:
        """Appends encoded pieces to buffers that double when they are full."""
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        ends = np.cumsum(sizes)
        self.flat = _grown(self.flat, self.filled + int(ends[-1]))
        self.starts, self.sizes = _grown(self.starts, first + len(coded)), _grown(self.sizes, first + len(coded))
        self.flat[self.filled : self.filled + int(ends[-1])] = np.concatenate(coded)
        self.starts[first : first + len(coded)] = self.filled + ends - sizes
        self.sizes[first : first + len(coded)] = sizes
        self.filled += int(ends[-1])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets) of the texts."""
        if len(self.index) > CACHE_PIECES:
            self._clear()
        words = [self.split(t) if t else [] for t in texts]
        index = self.index
        new = list({w for ws in words for w in ws if w not in index})
        if new:
            first = len(index)
            self._keep(self.vocabulary.encode_pieces([w.encode("utf-8", "replace") for w in new]), first)
            index.update(zip(new, range(first, first + len(new))))
        counts = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter((index[w] for ws in words for w in ws), np.int64, int(counts.sum()))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.arange(total) + np.repeat(self.starts[at] - (ends - sizes), sizes)]
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return flat, offsets


def encode_tagged(documents: DataFrame, tokenizers: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, tag, ids) of rows (doc_id, tag, text), as they come."""
    path = f"{tokenizers}/{name}.tiktoken"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                flat, offsets = encoder.encode(part.column(2).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids], ["doc_id", "tag", "ids"])

    return documents.select("doc_id", "tag", "text").mapInArrow(run, "doc_id long, tag string, ids array<int>")


def encode_documents(documents: DataFrame, tokenizers: str = TOKENIZERS, name: str = VOCABULARY, text: str = "text") -> DataFrame:
    """(doc_id, ids) of every document."""
    chosen = once(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), "doc_id")
    tagged = chosen.select("doc_id", F.lit("").alias("tag"), "text")
    return encode_tagged(tagged, tokenizers, name).select("doc_id", "ids")


def count_tokens(documents: DataFrame, tokenizers: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of every document; 0 for null and empty texts."""
    return encode_documents(documents, tokenizers, name).select("doc_id", F.size("ids").cast("long").alias("n_tokens"))
