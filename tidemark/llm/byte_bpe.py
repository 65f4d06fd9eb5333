"""Byte-level BPE on padded matrices.

A text is cut into matches of the vocabulary's pattern. The distinct matches of a piece of documents are sorted into
buckets by length; a bucket is one matrix of token ids, a row for each match. In every round each row merges its
leftmost pair of least rank: pair ranks come from a hash table of id pairs, only the two pairs beside a merge are looked
up again, and the merged cell is squeezed out of all rows at once, which shortens the matrix by one column. Rows without
a pair that merges leave the matrix.

Null or empty texts have no ids. Each document is encoded and decoded on its own, so ties, repeated rows and row order
don't matter, and an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.documents import kept, keyed_texts, lean, pieces, strings

#: Rank of a pair that doesn't merge.
NEVER = np.int32(np.iinfo(np.int32).max)
#: Distinct matches whose ids a worker keeps; it starts afresh beyond that.
KEPT_MATCHES = 300_000
#: Text bytes that are encoded at a time; their matches, as objects of Python, take some 20 times as much.
PIECE = 1 << 20
#: Cells of one matrix; longer buckets are worked off in turns.
CELLS = 1 << 21


class PairRanks:
    """An open-addressing hash table from two token ids to the rank (the id) of their merge."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NEVER, np.int32)
        todo = np.fromiter(pairs.keys(), np.int64, len(pairs))
        value = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(todo)
        while len(todo):  # every round, one of the keys that want a free slot gets it
            free = self.keys[slot] == -1
            self.keys[slot[free]] = todo[free]
            done = self.keys[slot] == todo
            self.values[slot[done]] = value[done]
            todo, value, slot = todo[~done], value[~done], (slot[~done] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids of equal shape; a negative id (padding) never merges."""
        shape = left.shape
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        out = np.full(keys.shape, NEVER, np.int32)
        at = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._slot(keys[at])
        while len(at):
            found = self.keys[slot]
            hit = found == keys[at]
            out[at[hit]] = self.values[slot[hit]]
            more = ~hit & (found != -1)
            at, slot = at[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)


class ByteBpe:
    """Encoder and decoder for the ranks of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.pair = PairRanks(ranks)
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_sizes = np.array([len(x) for x in tokens], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def merge_rows(self, rows: list[bytes]) -> list[np.ndarray]:
        """The ids of each row of bytes, merged in buckets of about equal length."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(rows)
        lengths = np.array([len(x) for x in rows], np.int64)
        order = np.argsort(lengths, kind="stable")
        start = 0
        while start < len(order):
            width = int(lengths[order[start]])
            limit = max(width + 3, width * 5 // 4)  # a bucket's widths are within a quarter
            stop = int(np.searchsorted(lengths[order], limit, side="right"))
            stop = max(start + 1, min(stop, start + CELLS // max(1, limit)))
            self._merge_bucket(rows, order[start:stop], out)
            start = stop
        return out

    def _merge_bucket(self, rows: list[bytes], at: np.ndarray, out: list[np.ndarray]) -> None:
        width = max(len(rows[i]) for i in at)
        padded = np.frombuffer(b"".join(rows[i].ljust(width, b"\0") for i in at), np.uint8).reshape(len(at), width)
        length = np.array([len(rows[i]) for i in at])
        ids = np.where(np.arange(width) < length[:, None], self.first[padded], np.int32(-1))
        rank = self.pair(ids[:, :-1], ids[:, 1:]) if width > 1 else np.zeros((len(at), 0), np.int32)
        while len(at):
            n, pairs = rank.shape
            each = np.arange(n)
            left = rank.argmin(axis=1) if pairs else np.zeros(n, np.int64)  # argmin takes the leftmost of equals
            least = rank[each, left] if pairs else np.full(n, NEVER)
            done = least == NEVER
            if done.any():
                for row in np.flatnonzero(done):
                    out[at[row]] = ids[row, : length[row]].copy()
                keep = ~done
                at, ids, rank, length, left, least = at[keep], ids[keep], rank[keep], length[keep], left[keep], least[keep]
                if not len(at):
                    return
                n, each = len(at), np.arange(len(at))
            ids[each, left] = least
            kept = np.ones(ids.shape, bool)
            kept[each, left + 1] = False
            ids = ids[kept].reshape(n, -1)
            kept = np.ones(rank.shape, bool)
            kept[each, left] = False
            rank = rank[kept].reshape(n, -1)
            length -= 1
            for shift in (-1, 0):  # the pairs that end and begin with the merged token
                place = left + shift
                ok = np.flatnonzero((place >= 0) & (place < rank.shape[1]))
                rank[ok, place[ok]] = self.pair(ids[ok, place[ok]], ids[ok, place[ok] + 1])
            most = int(length.max())
            if most < ids.shape[1]:
                ids, rank = ids[:, :most], rank[:, : most - 1]

    def _learn(self, new: list[str]) -> None:
        raw = [x.encode() for x in new]
        found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(raw)
        missing = []
        for i, x in enumerate(raw):
            whole = self.ranks.get(x)  # a match that is a token needs no merging
            if whole is None:
                missing.append(i)
            else:
                found[i] = np.array([whole], np.int32)
        for i, ids in zip(missing, self.merge_rows([raw[i] for i in missing]), strict=True):
            found[i] = ids
        sizes = np.array([len(x) for x in found], np.int64)
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, *found])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's ids end."""
        if len(self.known) > KEPT_MATCHES:
            self._forget()
        found = [self.pattern.findall(x) for x in texts]
        flat = [x for words in found for x in words]
        new = list(set(flat).difference(self.known))
        if new:
            self._learn(new)
        codes = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        sizes = self.sizes[codes]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.starts[codes] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[np.cumsum([len(words) for words in found], dtype=np.int64)] if texts else ends[:0]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids, and where the bytes of each text end."""
        sizes = self.token_sizes[ids]
        at = np.concatenate([[0], np.cumsum(sizes)])
        raw = self.token_bytes[np.repeat(self.token_starts[ids] - at[:-1], sizes) + np.arange(at[-1])]
        return raw.tobytes(), at[ends]


def coder(path: str, pattern: str) -> ByteBpe:
    """The coder of a vocabulary file (base64 token and rank a line); a Python worker builds it once, and lets it go when another
    operator's tasks come."""

    def build() -> ByteBpe:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return ByteBpe(ranks, pattern)

    return kept(f"byte-bpe {path} {pattern}", build)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) and decoded (binary) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for piece in pieces(batches, limit=PIECE):
            ids, ends = bpe.encode(strings(piece))
            raw, cuts = bpe.decode(ids, ends)
            of_ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
            places = np.concatenate([[0], cuts])
            decoded = [raw[a:b] for a, b in zip(places, cuts)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), of_ids, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    return keyed_texts(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (little-endian unsigned 32-bit) and of the bytes decoded from them.

    One row for each row of `docs`; a null or empty text has 0 tokens and the digests of nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for piece in pieces(batches, limit=PIECE):
            ids, ends = bpe.encode(strings(piece))
            raw, cuts = bpe.decode(ids, ends)
            begins, wide = np.concatenate([[0], ends[:-1]]), ids.astype("<u4")
            of_ids = [hashlib.sha256(wide[a:b]).hexdigest() for a, b in zip(begins, ends)]
            of_bytes = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(np.concatenate([[0], cuts[:-1]]), cuts)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(ends - begins, pa.int64()), pa.array(of_ids), pa.array(of_bytes)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return keyed_texts(docs, id_col, text_col).mapInArrow(
        lean(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
