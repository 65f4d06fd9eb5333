"""Token ids in raw shard files with a minimal perfect hash index.

A shard holds a range of document keys in ascending order. `ids-<shard>.bin` has nothing but the ids, little-endian, in
2 bytes each where the vocabulary allows, else 4. `ids-<shard>.idx` maps a key to its ids in constant time: levels of
bit arrays, where a key's index is the rank of its bit on the first level at which no other key shared its place, and
for each index a 32-bit fingerprint of the key (an unknown key is found out, but for one in four billion), the first
record of the key and their number, then where each record starts.

Files are written by tasks under a name of the attempt and moved to their place once whole, so a task that is run again
replaces a file by an equal one. The folder's URI may be of any file system that `pyarrow.fs` opens (file, hdfs, s3, gs).

Null texts are empty ones. Rows that share a key are all stored, next to each other; rows with a null key come first in
the first shard and are found under None. No rows: no shards, and an empty result.
"""

from __future__ import annotations

import functools
import gc
import io
import itertools
import math
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.documents import keyed_texts, pieces
from tidemark.session import scratch_path
from tidemark.sources.staging import settle

SHARD_ROWS = 16_384
#: The most shards; their bounds are held by the driver. Beyond it the shards grow.
MOST_SHARDS = 65_536
#: Bytes of a shard's ids that a reader holds at a time.
READ_BYTES = 8 << 20
KEPT_WORDS = 600_000
#: A line's letters (those of Latin-1, one character each in either case), if another kind of character follows that ends a
#: match (or nothing), and the rest of it.
HALVES = re.compile(r"^(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)(?=[^A-Za-z0-9'\u0080-\U0010ffff]|$))?(.*)$", re.M)
MAGIC = b"TIDX0001"
NULL_KEY = -(2**63)  # stands for a null key in sorting; such records are found by their count in the header


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: bit arrays by level, and the ranks of their bits."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # arrays of bool
        self.ranks, before = [], 0
        for bits in levels:
            self.ranks.append(before + np.cumsum(bits) - bits)
            before += int(bits.sum())
        self.size = before

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        left = keys
        while len(left):
            places = max(8, 2 * len(left))
            at = (_mix(left, len(levels) + 1) % np.uint64(places)).astype(np.int64)
            alone = np.bincount(at, minlength=places) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; any index or -1 for a key that isn't in the set."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            if not len(todo):
                break
            at = (_mix(keys[todo], level + 1) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[todo[hit]] = ranks[at[hit]]
            todo = todo[~hit]
        return out


def pack_index(keys: np.ndarray, sizes: np.ndarray, nulls: int) -> bytes:
    """The index of a shard whose records, in order, have these keys and numbers of ids; the first `nulls` have none."""
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
    distinct, first, count = np.unique(keys[nulls:], return_index=True, return_counts=True)
    hashed = PerfectHash.of(distinct)
    at = hashed(distinct)
    prints, firsts, counts = (np.zeros(len(distinct), "<u4") for _ in range(3))
    prints[at] = _mix(distinct, 0) & np.uint64(0xFFFFFFFF)
    firsts[at], counts[at] = first + nulls, count
    out = io.BytesIO()
    out.write(MAGIC + struct.pack("<QQQI", len(keys), nulls, len(distinct), len(hashed.levels)))
    for bits in hashed.levels:
        out.write(struct.pack("<Q", len(bits)) + np.packbits(bits).tobytes())
    for part in (prints, firsts, counts, starts):
        out.write(part.tobytes())
    return out.getvalue()


class ShardIndex:
    """Looks keys up in the bytes of an index."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not an index of a token shard")
        self.records, self.nulls, distinct, n_levels = struct.unpack_from("<QQQI", raw, 8)
        at, levels = 8 + struct.calcsize("<QQQI"), []
        for _ in range(n_levels):
            (size,) = struct.unpack_from("<Q", raw, at)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, (size + 7) // 8, at + 8))[:size].astype(bool))
            at += 8 + (size + 7) // 8
        self.hashed = PerfectHash(levels)
        self.prints, self.firsts, self.counts = (np.frombuffer(raw, "<u4", distinct, at + 4 * distinct * i) for i in range(3))
        self.starts = np.frombuffer(raw, "<u8", self.records + 1, at + 12 * distinct).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; number 0 where the fingerprint is another one."""
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = self.hashed(keys)
        known = (at >= 0) & (self.prints[at] == (_mix(keys, 0) & np.uint64(0xFFFFFFFF)))
        return np.where(known, self.firsts[at], 0).astype(np.int64), np.where(known, self.counts[at], 0).astype(np.int64)


class WordEncoder:
    """Ids of texts by a tokenizer that lower-cases and drops white space: each distinct word between spaces or line breaks
    is given to the library once. No match of such a tokenizer holds white space, so a text's ids are those of its words
    in turn; nor does one go on from a letter to a mark other than an apostrophe, so Latin-1 letters and what follows them
    are looked up apart, the letters in lower case."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.width = "<u2" if max(vocabulary.values()) < 65_536 else "<u4"
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a match
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {"": 0}  # the end of a text
        self.starts, self.sizes, self.ids = np.array([0, 1]), np.array([1, 0]), np.ones(1, self.width)  # and no ids at all

    def _add(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.starts), len(self.starts) + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def _encode(self, words: list[str]) -> None:
        letters = [x for x in words if x.isalpha()]
        lines = [" ".join(letters[i : i + 500]) for i in range(0, len(letters), 500)]
        coded = [x.ids for x in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.fromiter((i for x in coded for i in x), self.width, sum(map(len, coded)))
        stops = np.flatnonzero(self.last[ids]) + 1
        if len(stops) == len(letters):  # a word of letters is one match
            self._add(letters, np.diff(stops, prepend=0), ids)
            words = [x for x in words if not x.isalpha()]
        coded = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        self._add(words, sizes, np.fromiter((i for x in coded for i in x), self.width, int(sizes.sum())))

    def _learn(self, new: list[str]) -> None:
        halves = HALVES.sub(r"\1\n\2", "\n".join(new)).split("\n")
        first, rest = "\n".join(halves[::2]).lower().split("\n"), halves[1::2]
        self._encode(list({*first, *rest}.difference(self.known)))
        codes = np.array([np.fromiter(map(self.known.__getitem__, x), np.int64, len(new)) for x in (first, rest)]).T.reshape(-1)
        codes[codes == 0] = 1  # no letters, or no rest
        self._add(new, self.sizes[codes].reshape(-1, 2).sum(axis=1), self._gather(codes)[0])

    def _gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the codes in turn, and how many come before each code and after the last."""
        sizes = self.sizes[codes]
        after = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[np.repeat(self.starts[codes] - after[:-1], sizes) + np.arange(after[-1])], after

    def __call__(self, texts: list[str] | pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (none is null), each with `end_id` after it, and where each text's ids end."""
        collecting = gc.isenabled()
        gc.disable()  # there are many words and no cycles
        try:
            return self._ids_of(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), end_id)
        finally:
            if collecting:
                gc.enable()

    def _ids_of(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > KEPT_WORDS:
            self._forget()
        self.ids[0] = end_id
        cut = pa.compute.split_pattern(pa.compute.replace_substring(texts, "\n", " "), " ")
        numbered = cut.flatten().dictionary_encode()  # so that each distinct word alone is looked up among all known ones
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = np.fromiter(map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))
        codes[codes == 0] = 1  # between two spaces
        new = list(itertools.compress(words, codes < 0))
        if new:
            self._learn(new)
            codes[codes < 0] = np.arange(len(self.starts) - len(new), len(self.starts))
        stops = cut.offsets.to_numpy()[1:]
        ids, after = self._gather(np.insert(codes[numbered.indices.to_numpy()], stops, 0))
        return ids, after[stops + np.arange(1, len(stops) + 1)]


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def shard_bounds(docs: DataFrame, id_col: str, shard_rows: int) -> list[int]:
    """The least key of each shard but the first, from quantiles over all keys; at most MOST_SHARDS of them."""
    n = min(MOST_SHARDS, math.ceil(docs.count() / shard_rows))
    if n < 2:
        return []
    keys = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("k"))
    cuts = keys.agg(F.percentile_approx("k", F.array(*[F.lit(i / n) for i in range(1, n)]), max(10_000, 8 * n)).alias("q"))
    return sorted(set(cuts.first().q or []))


def write(
    docs: DataFrame, path: str, end_id: int = 1, shard_rows: int = SHARD_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[str, list[int], DataFrame]:
    """Writes the files; gives their folder, the bounds of the shards, and a table of shard, n_docs, n_tokens."""
    spark = docs.sparkSession
    folder, bounds = scratch_path(spark, "token-files"), shard_bounds(docs, id_col, shard_rows)
    edges = np.array(bounds, np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_encoder(path)
        for piece in pieces(batches):
            ids, ends = coder(piece.column("text").fill_null(""), end_id)
            begins = np.concatenate([[0], ends[:-1]])
            raw = [ids[a:b].tobytes() for a, b in zip(begins, ends)]
            keys = piece.column("doc_id").fill_null(NULL_KEY).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(np.searchsorted(edges, keys, side="right"), pa.int32()),
                    pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                    pa.array(raw, pa.binary()),
                ],
                ["doc_id", "shard", "crc", "ids"],
            )

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 if word_encoder(path).width == "<u2" else 4
        files, root = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        files.create_dir(root)
        now, out = None, None
        done: list[tuple[int, int, int]] = []

        def finish() -> None:
            out.close()
            all_keys, all_sizes = np.concatenate(keys), np.concatenate(sizes)
            with files.open_output_stream(f"{root}/{attempt}.idx") as index:
                index.write(pack_index(all_keys, all_sizes, nulls))
            files.move(f"{root}/{attempt}.bin", f"{root}/ids-{now:06d}.bin")
            files.move(f"{root}/{attempt}.idx", f"{root}/ids-{now:06d}.idx")
            done.append((now, len(all_keys), int(all_sizes.sum())))

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            for shard in np.unique(shards):
                part = batch.slice(int(np.searchsorted(shards, shard)), int((shards == shard).sum()))
                if shard != now:
                    if out is not None:
                        finish()
                    now, attempt, keys, sizes, nulls = int(shard), f"part-{uuid.uuid4().hex}", [], [], 0
                    out = files.open_output_stream(f"{root}/{attempt}.bin")
                nulls += part.column("doc_id").null_count
                keys.append(part.column("doc_id").fill_null(NULL_KEY).to_numpy(zero_copy_only=False))
                sizes.append(pa.compute.binary_length(part.column("ids")).to_numpy().astype(np.int64) // width)
                for ids in part.column("ids"):
                    out.write(ids.as_buffer())
        if out is not None:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in done], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))],
            ["shard", "n_docs", "n_tokens"],
        )

    coded = keyed_texts(docs, id_col, text_col).mapInArrow(encode, "doc_id long, shard int, crc long, ids binary")
    dealt = coded.repartitionById(len(bounds) + 1, F.col("shard"))
    ordered = dealt.sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "crc", "ids")
    shards = settle(ordered.mapInArrow(store, "shard int, n_docs long, n_tokens long"), "token-shards")
    return folder, bounds, shards


def read(keys: DataFrame, folder: str, bounds: list[int], shards: DataFrame, wide: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every record of the keys (a column
    `doc_id`), from the files; unknown keys have no row."""
    before = {r.shard: r.before for r in shards.selectExpr("shard", "sum(n_tokens) over (order by shard) - n_tokens before").collect()}
    edges, kind = np.array(bounds, np.int64), "<u4" if wide else "<u2"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("doc_id")
            at = np.searchsorted(edges, key.fill_null(NULL_KEY).to_numpy(zero_copy_only=False), side="right")
            yield pa.RecordBatch.from_arrays([key, pa.array(at, pa.int32())], ["doc_id", "shard"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        now, index, last = None, None, object()
        for batch in batches:
            shards_of = batch.column("shard").to_numpy()
            for shard in np.unique(shards_of):
                part = batch.column("doc_id").slice(int(np.searchsorted(shards_of, shard)), int((shards_of == shard).sum()))
                if shard != now:
                    now = int(shard)
                    if now not in before:
                        continue
                    with files.open_input_file(f"{root}/ids-{now:06d}.idx") as raw:
                        index = ShardIndex(raw.read())
                if now not in before:
                    continue
                wanted = [x for x in dict.fromkeys(part.to_pylist()) if x != last]  # sorted: repeats are neighbours
                last = wanted[-1] if wanted else last
                known = np.array([x for x in wanted if x is not None], np.int64)
                first, count = index.find(known)
                if None in wanted:
                    known, first = np.concatenate([[NULL_KEY], known]), np.concatenate([[0], first])
                    count = np.concatenate([[index.nulls], count])
                record = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
                key = np.repeat(known, count)
                none = np.repeat(np.arange(len(known)) < (None in wanted), count)
                starts, stops = index.starts[record], index.starts[record + 1]
                crc = _checksums(files, f"{root}/ids-{now:06d}.bin", starts, stops, kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, mask=none), pa.array(starts + before[now]), pa.array(stops - starts), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    placed = keys.select(F.col("doc_id").cast("long")).mapInArrow(place, "doc_id long, shard int")
    dealt = placed.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", F.asc_nulls_first("doc_id"))
    return dealt.mapInArrow(fetch, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _checksums(files: pyarrow.fs.FileSystem, path: str, starts: np.ndarray, stops: np.ndarray, kind: str) -> list[int]:
    """The CRC-32 of each record's ids as 32-bit integers; neighbouring records are read together."""
    size, out, i = np.dtype(kind).itemsize, [], 0
    with files.open_input_file(path) as raw:
        while i < len(starts):
            j = i + 1
            while j < len(starts) and starts[j] == stops[j - 1] and (stops[j] - starts[i]) * size <= READ_BYTES:
                j += 1
            ids = np.frombuffer(raw.read_at(int(stops[j - 1] - starts[i]) * size, int(starts[i]) * size), kind).astype("<u4")
            out += [zlib.crc32(ids[a - starts[i] : b - starts[i]]) for a, b in zip(starts[i:j], stops[i:j])]
            i = j
    return out


def store_and_read(docs: DataFrame, path: str, end_id: int = 1, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Writes all documents and reads every one back by its key."""
    folder, bounds, shards = write(docs, path, end_id, shard_rows)
    return read(docs.select("doc_id"), folder, bounds, shards, wide=word_encoder(path).width == "<u4")
