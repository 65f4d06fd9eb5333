"""Removal of repeated byte strings, over enhanced suffix arrays.

A string of `length` bytes that starts at two places is found in four steps.

1. Anchors. Each window of `length` bytes names the place of its least hashed 64-byte gram, so equal windows name the
   same place in themselves, and about one place in 170 is named at all. Anchors with equal grams may lie in a repeat.
2. Classes. Anchors whose whole surroundings (all windows that could name them) are equal are one class. A class of two
   anchors or more is repeated throughout, however many copies there are, and only one of them is looked at again.
3. Trees. For the other anchors of a gram, with one anchor of each class beside them, a suffix array of the text from the
   anchor on is built with its array of common prefixes, and a stack scan over it gives the intervals of the common-prefix
   tree. An interval whose members are all preceded by the same bytes tells nothing that its parent, or their class,
   doesn't; in the others, the longest common text to the left of each member with any other member, not its neighbour in
   the array alone, is joined with the interval's common prefix to the maximal repeat around it.
   Grams with more classes than `HOT_CLASSES` are first split by longer strings around them: a window has its anchor in
   its first or second half, and either half of the windows has a longer string in common. What is still too many is
   split again, and anchors whose shorter surroundings are now equal are one class, so windows inside a very common
   passage are found without a tree, and no task has to hold all its anchors.
4. Cover. What the repeats of at least `length` bytes cover is removed from each text.

Where a number of words is given too, strings of so many whole words that are repeated are removed however short they are:
those under `length` bytes, which are few, meet by two hashes of the string.

Bytes are UTF-8. Matches lie within a text; both places may be in the same text and may overlap. Null texts are empty
ones; texts shorter than `length` are kept whole. Repeated rows are repeats of each other. Every row of the input has a
row of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.documents import lean, pieces, ship
from tidemark.sources.staging import settle

LENGTH = 400
GRAM = 64
HOT_CLASSES = 8_192
#: Bytes that are hashed at a time; longer texts in overlapping parts.
PART_BYTES = 1 << 19
#: Fixed odd multipliers of the rolling hashes.
BASES = (0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4F)
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any substring of some bytes, from running sums of bytes times powers (modulo 2^64)."""

    def __init__(self, raw: np.ndarray, base: int = 0):
        size = len(raw) + 1
        if base not in _powers or len(_powers[base][0]) < size:
            most = max(size, PART_BYTES + 4 * LENGTH)
            step = [BASES[base], pow(BASES[base], -1, 2**64)]
            made = [np.full(most, x, np.uint64) for x in step]
            for x in made:
                x[0] = 1
            _powers[base] = tuple(np.cumprod(x, dtype=np.uint64) for x in made)
        self.inverse = _powers[base][1]
        values = _mixed(np.arange(256, dtype=np.uint64) + np.uint64(BASES[1 - base]))[raw]
        self.sums = np.zeros(size, np.uint64)
        np.cumsum(values * _powers[base][0][: len(raw)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stop] - self.sums[start]) * self.inverse[start])

    def grams(self, size: int) -> np.ndarray:
        return _mixed((self.sums[size:] - self.sums[:-size]) * self.inverse[: len(self.sums) - size])


def anchors(
    raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, first: int, last: int, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the windows that start in [first, last) of the texts raw[begins[i]:ends[i]]: their text, place, the
    hash of their gram and of their surroundings."""
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none
    rolling = Rolling(raw)
    hashes = rolling.grams(gram)
    places = np.uint64(2**31 - 1)
    keyed = (hashes & ~places) | np.arange(len(hashes), dtype=np.uint64)  # of equal grams, the leftmost
    width = length - gram + 1
    blocks = -(-len(keyed) // width) * width
    padded = np.full(blocks, ~np.uint64(0))
    padded[: len(keyed)] = keyed
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(raw) - length + 1
    least = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    text = np.searchsorted(begins, np.arange(starts), side="right") - 1
    whole = np.arange(starts) + length <= ends[text]
    whole[:first], whole[last:] = False, False
    at = np.unique((least[whole] & places).astype(np.int64))
    text = np.searchsorted(begins, at, side="right") - 1
    low = np.maximum(begins[text], at - (length - gram))
    high = np.minimum(ends[text], at + length)
    shape = ((at - low).astype(np.uint64) << np.uint64(32)) | (high - at).astype(np.uint64)
    around = _mixed(rolling(low, high) ^ _mixed(shape))
    return text, at - begins[text], hashes[at].view(np.int64), around.view(np.int64)


def _keyed(docs: DataFrame, carry: list[str], text_col: str) -> DataFrame:
    """`row` (a struct of the carried columns), `text` (binary) and `k`, 16 bytes that are equal for equal texts."""
    text = F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b""))
    return docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"), text.alias("text"), F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("k")
    )


def find_anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """k, pos, a (hash of the gram), c (hash of the surroundings) of all anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=PART_BYTES):
            raw = [x.as_py() for x in piece.column("text")]
            sizes = np.array([len(x) for x in raw], np.int64)
            keys = piece.column("k")
            if len(raw) > 1 or sizes[0] <= PART_BYTES:
                ends = np.cumsum(sizes)
                found = [anchors(np.frombuffer(b"".join(raw), np.uint8), ends - sizes, ends, 0, int(ends[-1]), length, gram)]
            else:
                found, n = [], int(sizes[0])
                for start in range(0, n - length + 1, PART_BYTES):
                    low, stop = max(0, start - length), min(n, start + PART_BYTES + 3 * length)
                    part = np.frombuffer(raw[0], np.uint8, stop - low, low)
                    first, last = start - low, start - low + PART_BYTES
                    t, at, a, c = anchors(part, np.array([0]), np.array([len(part)]), first, last, length, gram)
                    found.append((t, at + low, a, c))
            text, at, a, c = (np.concatenate(x) for x in zip(*found, strict=True))
            if len(found) > 1:
                at, kept = np.unique(at, return_index=True)
                text, a, c = text[kept], a[kept], c[kept]
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(text)), pa.array(at), pa.array(a), pa.array(c)], ["k", "pos", "a", "c"]
            )

    long_enough = texts.where(F.octet_length("text") >= length).select("k", "text")
    return long_enough.mapInArrow(lean(run), "k binary, pos long, a long, c long")


def _sorted_prefixes(rows: list[bytes], group: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the rows by group and bytes, the padded bytes in that order, and common prefixes with the row before
    (-1 at the first row of a group)."""
    sizes = np.array([len(x) for x in rows], np.int64)
    table = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in rows), np.uint8).reshape(len(rows), width)
    keys = np.concatenate(
        [group.astype(">u4").view(np.uint8).reshape(-1, 4), table, sizes.astype(">u2").view(np.uint8).reshape(-1, 2)], axis=1
    )
    order = np.argsort(np.ascontiguousarray(keys).view(f"V{keys.shape[1]}").ravel(), kind="stable")
    table, sizes, group = table[order], sizes[order], group[order]
    common = np.full(len(rows), -1, np.int64)
    if len(rows) > 1:
        common[1:] = _common(table[1:], table[:-1], np.minimum(sizes[1:], sizes[:-1]))
        common[1:][group[1:] != group[:-1]] = -1
    return order, table, common


def _common(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The common prefix of each row of x and y, `most` at most."""
    differ = x != y
    first = differ.argmax(axis=1)
    return np.minimum(np.where(differ[np.arange(len(x)), first], first, x.shape[1]), most)


def intervals(common: np.ndarray) -> list[tuple[int, int, int]]:
    """The intervals of the common-prefix tree of a suffix array: first and last index and common prefix, children
    before parents, by a scan with a stack."""
    out, stack = [], [(0, 0)]  # common prefix, first index
    for i in range(1, len(common) + 1):
        value = int(common[i]) if i < len(common) else -1
        first = i - 1
        while stack and stack[-1][0] > value:
            size, first = stack.pop()
            if size > 0:
                out.append((first, i - 1, size))
        if not stack or stack[-1][0] < value:
            stack.append((value, first))
    return out


def repeats(left: list[bytes], right: list[bytes], group: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor, the bytes before and after its place that repeats of at least `length` bytes around it cover; 0
    and 0 where there are none. `left` are the bytes before the anchor, backwards; groups are anchors of equal grams."""
    n = len(right)
    width_left, width_right = length - gram, length
    order, _, common = _sorted_prefixes(right, group, width_right)
    by_left, left_table, _ = _sorted_prefixes(left, group, width_left)
    rank = np.empty(n, np.int64)
    rank[by_left] = np.arange(n)
    rank = rank[order]  # of each suffix, its place among the texts to the left
    left_sizes = np.array([len(left[i]) for i in by_left], np.int64)
    best_left, best_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # groups of two, the most frequent ones, have one interval each: all of them at once
    firsts = np.flatnonzero(common == -1)
    sizes = np.diff(np.append(firsts, n))
    pairs = firsts[sizes == 2]
    if len(pairs):
        x, y = rank[pairs], rank[pairs + 1]
        before = _common(left_table[x], left_table[y], np.minimum(left_sizes[x], left_sizes[y]))
        after = common[pairs + 1]
        long = before + after >= length
        for side in (pairs, pairs + 1):
            best_left[side[long]], best_right[side[long]] = before[long], after[long]
    for start, size in zip(firsts[sizes > 2], sizes[sizes > 2], strict=True):
        for low, high, after in intervals(common[start : start + size]):
            if after + width_left < length:
                continue
            members = np.arange(start + low, start + high + 1)
            members = members[np.argsort(rank[members])]
            at = rank[members]
            same = _common(left_table[at[1:]], left_table[at[:-1]], np.minimum(left_sizes[at[1:]], left_sizes[at[:-1]]))
            if (same == width_left).all():  # no diversity to the left, as far as is looked at: whole members are equal
                same = np.full(len(same), width_left)
            before = np.maximum(np.append(same, 0), np.insert(same, 0, 0))
            long = before + after >= length
            hit = members[long]
            best_left[hit] = np.maximum(best_left[hit], before[long])
            best_right[hit] = np.maximum(best_right[hit], after)
    found_left, found_right = np.empty(n, np.int64), np.empty(n, np.int64)
    found_left[order], found_right[order] = best_left, best_right
    return found_left, found_right


def _surroundings(texts: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """The wanted anchors with the bytes before (backwards) and after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=PART_BYTES):
            out: list[list] = [[] for _ in range(7)]
            for key, text, items in zip(piece.column("k").to_pylist(), piece.column("text").to_pylist(), piece.column("items").to_pylist()):
                for item in items:
                    at = item["pos"]
                    row = (item["a"], item["n"], item["classes"], key, at, text[max(0, at - length + gram) : at][::-1], text[at : at + length])
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(out, kinds)], ["a", "n", "classes", "k", "pos", "before", "after"]
            )

    by_text = wanted.groupBy("k").agg(F.collect_list(F.struct("a", "n", "classes", "pos")).alias("items"))
    each = texts.select("k", "text").dropDuplicates(["k"])
    return each.join(by_text, "k").mapInArrow(
        lean(run), "a long, n long, classes long, k binary, pos long, before binary, after binary"
    )


def _trees(around: DataFrame, length: int, gram: int) -> DataFrame:
    """k, low, high that repeats cover, for anchors that are alone in their class."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        a = np.array([r[0] for r in rows], np.int64)
        group = np.concatenate([[0], np.cumsum(a[1:] != a[:-1])])
        before, after = repeats([r[4] for r in rows], [r[5] for r in rows], group, length, gram)
        alone = np.flatnonzero((np.array([r[1] for r in rows]) == 1) & (after > 0))
        at = np.array([r[3] for r in rows], np.int64)[alone]
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][2] for i in alone], pa.binary()), pa.array(at - before[alone]), pa.array(at + after[alone])],
            ["k", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for part in range(0, batch.num_rows, 2_000):
                rows = list(zip(*(x.to_pylist() for x in batch.slice(part, 2_000).columns)))
                held += rows
                cut = len(held)
                while cut and held[cut - 1][0] == held[-1][0]:
                    cut -= 1
                if cut >= 2_000:  # whole groups alone
                    yield solve(held[:cut])
                    held = held[cut:]
        if held:
            yield solve(held)

    rows = around.select("a", "n", "k", "pos", "before", "after").repartition("a").sortWithinPartitions("a")
    return rows.mapInArrow(lean(run), "k binary, low long, high long")


def _hash64(*parts: object) -> int:
    digest = hashlib.blake2b(digest_size=8)
    for part in parts:
        digest.update(part if isinstance(part, bytes) else str(part).encode())
        digest.update(b"|")
    return int.from_bytes(digest.digest(), "little", signed=True)


def _halves(around: DataFrame, length: int) -> DataFrame:
    """Each anchor for either half of the windows it may be in: those that start `near` to `far` bytes before it. A half
    has a longer string in common, whose hash is the new key, and shorter surroundings, whose hash is the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[tuple[int | None, int | None]]] = [[], []]
            for a, near, far, before, after in zip(*(batch.column(x).to_pylist() for x in ("a", "near", "far", "before", "after"))):
                middle = (near + far) // 2
                for half, low, high in zip(out, (near, middle + 1), (middle, far)):
                    common = before[:low][::-1] + after[: length - high]
                    reach = before[:high][::-1], after[: length - low]
                    if low <= high and len(common) == low + length - high and sum(map(len, reach)) >= length:
                        half.append((_hash64(a, low, common), _hash64(low, *reach)))
                    else:  # no such window is within the text
                        half.append((None, None))
            keys = [pa.array([x[i] for x in half], pa.int64()) for half in out for i in (0, 1)]
            names = ["n", "k", "pos", "before", "after", "near", "far"]
            yield pa.RecordBatch.from_arrays([*keys, *map(batch.column, names)], ["a1", "c1", "a2", "c2", *names])

    kinds = "n long, k binary, pos long, before binary, after binary, near long, far long"
    both = around.select("a", *[x.split()[0] for x in kinds.split(", ")]).mapInArrow(
        lean(run), f"a1 long, c1 long, a2 long, c2 long, {kinds}"
    )
    both = settle(both, "dedup-halves")
    middle = F.floor((F.col("near") + F.col("far")) / 2)
    kept = ["n", "k", "pos", "before", "after"]
    first = both.where("a1 is not null").select(F.col("a1").alias("a"), F.col("c1").alias("c"), *kept, "near", middle.alias("far"))
    second = both.where("a2 is not null").select(
        F.col("a2").alias("a"), F.col("c2").alias("c"), *kept, (middle + 1).alias("near"), "far"
    )
    return first.union(second)


def _groups(rows: DataFrame) -> DataFrame:
    """The number of classes of each key that has several, one of which at least is a single anchor."""
    return rows.groupBy("a").agg(F.count("*").alias("classes"), F.min("n").alias("least")).where("classes > 1 and least = 1")


def cover(texts: DataFrame, length: int, gram: int, hot_classes: int) -> DataFrame:
    """k and `spans`: an array of low, high that repeats cover; low may be under 0 and high beyond the text."""
    found = settle(find_anchors(texts, length, gram), "dedup-anchors")
    grams = found.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    again = settle(found.join(grams, "a"), "dedup-repeated")
    classes = again.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(F.struct("k", "pos")).alias("one"))
    classes = settle(classes.select("a", "c", "n", "one.k", "one.pos"), "dedup-classes")
    around = _surroundings(texts, classes.join(_groups(classes), "a"), length, gram)
    around = around.withColumn("near", F.lit(0).cast("long")).withColumn("far", F.lit(length - gram).cast("long"))
    around = settle(around, "dedup-surroundings")
    parts = _trees(around.where(F.col("classes") <= hot_classes), length, gram)
    while not (hot := around.where(F.col("classes") > hot_classes)).isEmpty():
        halved = _halves(hot, length)
        merged_classes = halved.groupBy("a", "c").agg(F.sum("n").alias("all"), F.min(F.struct("k", "pos")).alias("one"))
        halved = halved.join(merged_classes, ["a", "c"])
        equal = halved.where("n = 1 and all > 1").select("k", (F.col("pos") - F.col("far")).alias("low"), (F.col("pos") - F.col("near") + length).alias("high"))
        left = halved.where(F.struct("k", "pos") == F.col("one")).drop("n", "one").withColumnRenamed("all", "n")
        around = settle(left.join(_groups(left), "a"), "dedup-surroundings")
        parts = parts.union(equal).union(_trees(around.where(F.col("classes") <= hot_classes), length, gram))
    whole = again.join(classes.where("n > 1").select("a", "c"), ["a", "c"]).select("k", "pos").distinct()
    whole = whole.select("k", (F.col("pos") - (length - gram)).alias("low"), (F.col("pos") + length).alias("high"))
    spans = whole.union(parts).groupBy("k").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return settle(spans, "dedup-spans")


def short_strings(texts: DataFrame, length: int, words: int) -> DataFrame:
    """k and `spans` of the repeated strings of so many words, from a word's first byte to a word's last, under `length` bytes."""

    def of_text(text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        for start in range(0, len(text), PART_BYTES):
            begin = max(0, start - 1)
            raw = np.frombuffer(text, np.uint8)[begin : start + PART_BYTES + length]
            edge = np.flatnonzero(np.diff(np.concatenate([[True], WHITE[raw], [True]]).astype(np.int8)))
            first, last = edge[::2][: -words + 1 or None], edge[1::2][words - 1 :]  # of the strings; a text's edges are spaces
            some = (last - first < length) & (first + begin >= start) & (first + begin < start + PART_BYTES)
            some &= (first > 0) | (begin == 0)
            first, last = first[some], last[some]
            yield Rolling(raw)(first, last), Rolling(raw, 1)(first, last), first + begin, last + begin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=PART_BYTES):
            for key, text in zip(piece.column("k"), piece.column("text")):
                for h, g, low, high in of_text(text.as_py()):
                    columns = [pa.array(x) for x in (h.view(np.int64), g.view(np.int64), low, high)]
                    if len(low):
                        yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(low), pa.binary()), *columns], ["k", "h", "g", "low", "high"])

    found = settle(texts.select("k", "text").mapInArrow(lean(run), "k binary, h long, g long, low long, high long"), "dedup-words")
    again = found.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1")
    return found.join(again, ["h", "g"], "left_semi").groupBy("k").agg(F.collect_set(F.struct("low", "high")).alias("spans"))


def merged(spans: list[dict], size: int) -> list[tuple[int, int]]:
    """The spans, clipped to the text, as maximal runs in order."""
    out: list[tuple[int, int]] = []
    for low, high in sorted((max(0, s["low"]), min(size, s["high"])) for s in spans):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out


Finish = Callable[[pa.RecordBatch, list[list[tuple[int, int]]]], pa.RecordBatch]


def deduplicate(
    docs: DataFrame,
    carry: list[str],
    finish: Finish,
    schema: str,
    length: int = LENGTH,
    gram: int = GRAM,
    hot_classes: int = HOT_CLASSES,
    text_col: str = "text",
    words: int | None = None,
) -> DataFrame:
    """What `finish` makes of `row` (a struct of the carried columns), `text` (binary) and the runs, as start and stop, of
    the bytes of each text that are to be removed: repeats of `length` bytes or, if given, of so many words."""
    ship(docs.sparkSession)
    texts = _keyed(docs, carry, text_col)
    spans = cover(texts, length, gram, hot_classes)
    if words is not None:
        spans = spans.union(short_strings(texts, length, words)).groupBy("k").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=1 << 20):
            sizes = pa.compute.binary_length(piece.column("text")).to_pylist()
            yield finish(piece, [merged(s, n) if s else [] for s, n in zip(piece.column("spans").to_pylist(), sizes)])

    return texts.join(spans, "k", "left").select("row", "text", "spans").mapInArrow(lean(run), schema)


def kept_parts(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """The text without the runs."""
    out, at = [], 0
    for start, stop in runs:
        out.append(text[at:start])
        at = stop
    return b"".join([*out, text[at:]])


def digests(
    docs: DataFrame, id_col: str = "doc_id", length: int = LENGTH, gram: int = GRAM, hot_classes: int = HOT_CLASSES
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and SHA-256 of what is kept of every text, and the kept text itself (bytes of
    characters that were cut in part are replaced)."""

    def finish(piece: pa.RecordBatch, runs: list[list[tuple[int, int]]]) -> pa.RecordBatch:
        texts = piece.column("text").to_pylist()
        numbers = [(len(x), sum(b - a for a, b in r), len(r)) for x, r in zip(texts, runs)]
        left = [kept_parts(x, r) for x, r in zip(texts, runs)]
        return pa.RecordBatch.from_arrays(
            [
                piece.column("row").field(0).cast(pa.int64()),
                *(pa.array([x[i] for x in numbers], pa.int64()) for i in range(3)),
                pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()),
                pa.array([x.decode(errors="replace") for x in left], pa.string()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"],
        )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"
    return deduplicate(docs, [id_col], finish, schema, length, gram, hot_classes)
