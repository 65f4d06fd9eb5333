"""Near-duplicate join on word shingles, by token-combination prefixes.

Two texts link when their sets of 5-word shingles have a Jaccard similarity of at least 3/4. Sets are sorted by one
global order; two similar sets share a shingle in the prefixes of n - ceil(3n/4) + 1 shingles each, and k shingles when
the prefixes are k - 1 longer.

1. Shingles are counted within tasks, and those that come often in a task are added up: a bounded list of frequent ones.
   (Any list would do; a better one saves work.) In the global order the rare shingles come first, by hash, then the
   frequent ones, the most frequent at the end.
2. Prefixes are extended by one, so similar sets share two shingles there: one that is rare, which is indexed alone, or
   two frequent ones, so frequent shingles are indexed in pairs. Sets over `PAIRED_SIZE`, whose pairs would be too many,
   are indexed by single frequent shingles, as are those that are small enough to be paired but near that size.
3. Groups of sets with a common key are cut where neighbouring sizes rule similarity out. The sets of the few groups that
   are still large are indexed once more among themselves, with exact counts of their shingles.
4. Links are looked for in turns, and groups that a turn leaves within one component are done. First each set is compared with
   one that shares most of its least hashes, so that most of a large group of near copies is connected at the cost of one
   comparison a set. Then members of a group that are of different components are compared by small sketches of their sets, and
   of those that sketches don't rule out (what they rule out can't be similar) the likeliest of each set; sets that have more are
   looked at again, with all of theirs. Candidate pairs are verified on the whole sets, and no pair that could connect two
   components is left untested.

Equal sets are one node, so copies are never paired. Texts without words (null ones too) have no shingles and no links;
a component's id is its smallest document id, nulls left aside. Repeated rows are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.documents import keyed_texts, lean, pieces, release
from tidemark.llm.shingles import shingle_sets
from tidemark.llm.suffix_dedup import _mixed
from tidemark.sources.staging import settle

WORDS = 5
#: Sets beyond which a shingle is frequent.
FREQUENT = 32
#: Sets beyond which a group of the first index is dealt with by a second one.
MOST_MEMBERS = 256
#: The most frequent shingles that are told to all tasks; the others are indexed alone.
KNOWN = 65_536
#: Sets of more shingles aren't indexed by pairs.
PAIRED_SIZE = 2_048
#: Times a shingle comes in a task's sets before the task reports it.
REPORTED = 4
PIECE = 1 << 20
FILTER_BITS = 1 << 24
#: Bits of the second hash of a set.
HASH_BITS = 24
#: Nodes of a block; a task holds two.
BLOCK_NODES = 2_048
#: Words of sketches that are compared at a time.
COMPARED_WORDS = 1 << 20
#: Nodes of small bundles that are worked off at a time.
SOLVED_NODES = 1_024
#: Pairs of nodes that are compared by sketches rather than one more row of a group is sent.
PAIRS_A_ROW = 32
#: Candidates of a node in the turn that takes the likeliest.
BEST = 16
#: Equal ranges of hashes, of each of which a set's least one is kept: 2 to this power.
RANGE_BITS = 3


def _least(n: np.ndarray) -> np.ndarray:
    """Shingles in a prefix: n - ceil(3 n / 4) + 1."""
    return n - (3 * n + 3) // 4 + 1


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _sets(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of a piece's texts, where each set starts, its size, and two hashes of it (0 for an empty set)."""
    texts = [(x or "").encode() for x in piece.column("text").to_pylist()]
    values, ends = shingle_sets(texts, WORDS)
    sizes = np.diff(ends, prepend=0)
    starts = ends - sizes
    with np.errstate(over="ignore"):
        sums = [np.concatenate([[np.uint64(0)], np.cumsum(_mixed(values ^ np.uint64(x)))]) for x in (0x51, 0xA7)]
    one, two = (_mixed(s[ends] - s[starts] + sizes.astype(np.uint64)) for s in sums)
    return values, starts, sizes, one, two >> np.uint64(64 - HASH_BITS)  # 88 bits tell sets apart


def _first_of_each(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which rows are the first of their set."""
    order = np.lexsort((v, u))
    new = np.ones(len(u), bool)
    new[1:] = (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])
    out = np.zeros(len(u), bool)
    out[order[new]] = True
    return out


def describe(docs: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """doc_id, a hash of the text, n and the hashes u, v of each document's set; and the frequent shingles, sorted, with their
    counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        seen: list[np.ndarray] = []
        for piece in pieces(batches, limit=PIECE):
            values, _, sizes, u, v = _sets(piece)
            seen.append(values[np.repeat(_first_of_each(u, v), sizes)])  # copies don't make a shingle frequent
            if sum(map(len, seen)) > 1_000_000:  # what comes seldom in so many is not hot
                seen = [_often(seen, 2)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("text_hash"), pa.array(sizes), _signed(u), _signed(v), pa.array(np.zeros(len(u), np.int32))],
                ["doc_id", "text_hash", "n", "u", "v", "times"],
            )
        if seen:
            value, times = np.unique(np.concatenate(seen), return_counts=True)
            kept = times >= REPORTED
            none = pa.nulls(int(kept.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, _signed(value[kept]), none, pa.array(times[kept].astype(np.int32))], ["doc_id", "text_hash", "n", "u", "v", "times"]
            )

    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rows = settle(hashed.mapInArrow(lean(run), "doc_id long, text_hash long, n long, u long, v long, times int"), "join-sets")
    often = rows.where("times > 0").groupBy("u").agg(F.sum("times").alias("times"))
    return rows.where("times = 0").drop("times"), *_most_frequent(often, "u", "times")


def _most_frequent(counts: DataFrame, value: str, times: str) -> tuple[np.ndarray, np.ndarray]:
    """The frequent shingles, KNOWN of them at most, sorted, and their counts."""
    table = counts.where(F.col(times) > FREQUENT).orderBy(F.desc(times), value).limit(KNOWN).toArrow()
    known = table[value].to_numpy().view(np.uint64)
    order = np.argsort(known)
    return known[order], table[times].to_numpy()[order]


def _often(parts: list[np.ndarray], least: int) -> np.ndarray:
    value, times = np.unique(np.concatenate(parts), return_counts=True)
    return np.repeat(value[times >= least], times[times >= least])


def _within(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def prefix_keys(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, frequent: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index keys of sets of sorted shingles, and the set that each belongs to: the rare shingles of the extended
    prefix alone, its frequent ones in pairs."""
    width = np.where(sizes > 0, np.minimum(_least(sizes) + 1, sizes), 0)
    of = np.repeat(np.arange(len(sizes)), sizes)
    often = _within(values, frequent)
    before = np.cumsum(~often) - ~often  # rare shingles before each shingle
    rank = before - before[np.minimum(starts, len(values) - 1)][of] if len(values) else before
    taken = ~often & (rank < width[of])
    keys, sets = [values[taken] >> np.uint64(1)], [of[taken]]
    rare = np.bincount(of[~often], minlength=len(sizes))
    for i in np.flatnonzero(rare < width):
        common = values[starts[i] : starts[i] + sizes[i]]
        common = common[often[starts[i] : starts[i] + sizes[i]]]
        common = common[np.lexsort((common, times[np.searchsorted(frequent, common)]))][: width[i] - rare[i]]
        with np.errstate(over="ignore"):
            if sizes[i] <= PAIRED_SIZE and len(common) > 1:
                low = np.sort(common)
                a, b = np.triu_indices(len(low), 1)
                keys.append(_mixed(low[a] + _mixed(low[b] + np.uint64(1))) >> np.uint64(1))
                sets.append(np.full(len(a), i))
            if 4 * sizes[i] > 3 * PAIRED_SIZE or sizes[i] < 4:  # a set of under four shingles has a prefix of one
                keys.append(_mixed(common + np.uint64(2)) >> np.uint64(1))
                sets.append(np.full(len(common), i))
    return np.concatenate(keys).view(np.int64), np.concatenate(sets)


def index_prefixes(docs: DataFrame, frequent: np.ndarray, times: np.ndarray) -> DataFrame:
    """key, u, w of every distinct set; w is n and v in one number."""
    known = docs.sparkSession.sparkContext.broadcast((frequent, times))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=PIECE):
            values, starts, sizes, u, v = _sets(piece)
            alone = _first_of_each(u, v)  # equal sets are indexed once
            values = values[np.repeat(alone, sizes)]
            u, v, sizes = u[alone], v[alone], sizes[alone]
            key, of = prefix_keys(values, np.cumsum(sizes) - sizes, sizes, *known.value)
            w = sizes << HASH_BITS | v.view(np.int64)
            for at in range(0, len(key), 200_000):
                some, row = key[at : at + 200_000], of[at : at + 200_000]
                yield pa.RecordBatch.from_arrays([pa.array(some), _signed(u[row]), pa.array(w[row])], ["key", "u", "w"])

    return docs.mapInArrow(lean(run), "key long, u long, w long")


def _grouped(
    batches: Iterator[pa.RecordBatch], key: str, columns: list[str], rows: int = 20_000
) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Whole groups of rows that are sorted by key, many small ones at a time: the keys and the columns."""
    held: list[list[np.ndarray]] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in (key, *columns)])
        count += batch.num_rows
        if count < rows or held[0][0][0] == held[-1][0][-1]:
            continue
        joined = [np.concatenate(x) for x in zip(*held, strict=True)]
        cut = int(np.searchsorted(joined[0], joined[0][-1]))
        yield joined[0][:cut], [x[:cut] for x in joined[1:]]
        held, count = [[x[cut:] for x in joined]], len(joined[0]) - cut
    if held:
        joined = [np.concatenate(x) for x in zip(*held, strict=True)]
        yield joined[0], joined[1:]


def group_members(index: DataFrame, frequent: int | None) -> DataFrame:
    """g, u, v, n of groups of two sets or more whose sizes are alike; g is a hash of the members, so groups of the same
    members are one. With `frequent`, sets of larger groups are marked (g null) instead of grouped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for key, (u, w) in _grouped(batches, "key", ["u", "w"]):
            again = key[1:] == key[:-1]  # most keys come once
            shared = np.append(again, False) | np.insert(again, 0, False)
            if not shared.any():
                continue
            key, u, w = key[shared], u[shared], w[shared]
            v, n = w & ((1 << HASH_BITS) - 1), w >> HASH_BITS
            order = np.lexsort((v, u, n, key))
            key, u, v, n = key[order], u[order], v[order], n[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])
            key, u, v, n = key[new], u[new], v[new], n[new]
            brk = np.ones(len(key), bool)
            brk[1:] = (key[1:] != key[:-1]) | (4 * n[:-1] < 3 * n[1:])
            first = np.flatnonzero(brk)
            size = np.diff(np.append(first, len(key)))
            if frequent is not None:
                many = size > frequent
                rows = np.repeat(many, size)
                marked = np.unique(np.stack([u[rows], v[rows], n[rows]]), axis=1)
                if marked.shape[1]:
                    yield _members(None, *marked)
            else:
                many = np.zeros(len(size), bool)
            some = np.repeat((size > 1) & ~many, size)
            if not some.any():
                continue
            u, v, n = u[some], v[some], n[some]
            size = size[(size > 1) & ~many]
            first = np.cumsum(size) - size
            with np.errstate(over="ignore"):
                each = _mixed(u.view(np.uint64) + _mixed(v.view(np.uint64)))
                g = _mixed(np.add.reduceat(each, first)).view(np.int64)
            fresh = np.array([x not in seen for x in g.tolist()])
            _, once = np.unique(g, return_index=True)
            alone = np.zeros(len(g), bool)
            alone[once] = True
            fresh &= alone
            if len(seen) < 500_000:
                seen.update(g[fresh].tolist())
            rows = np.repeat(fresh, size)
            if rows.any():
                yield _members(np.repeat(g, size)[rows], u[rows], v[rows], n[rows])

    dealt = index.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(lean(run), "g long, u long, v long, n int").distinct()


def _members(g: np.ndarray | None, u: np.ndarray, v: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    group = pa.nulls(len(u), pa.int64()) if g is None else pa.array(g)
    return pa.RecordBatch.from_arrays([group, pa.array(u), pa.array(v), pa.array(n.astype(np.int32))], ["g", "u", "v", "n"])


def _bits(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of a column `h` of hashes: FILTER_BITS bits, whatever the number of rows."""
    places = ids.select(F.explode(F.array(F.col("h"), F.shiftrightunsigned("h", 32))).alias("p"))
    places = places.select(F.expr(f"pmod(p, {FILTER_BITS})").alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    table = words.toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy()
    return out.view(np.uint64)


def _passing(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows whose hash `h` may be in the filter, in bounded pieces."""
    for batch in batches:
        h = batch.column("h").to_numpy()
        passes = np.ones(len(h), bool)
        for p in (h, (h.view(np.uint64) >> np.uint64(32)).view(np.int64)):
            p = p % FILTER_BITS
            passes &= (bits[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
        yield from pieces(iter([batch.filter(pa.array(passes))]), limit=PIECE)


def sketch(values: np.ndarray) -> bytes:
    """The size of a set of hashes, and whether an odd number of them ends in each of n to 2n equally long rows of bits."""
    ends = 1 << max(6, len(values).bit_length())
    odd = np.bincount((values & np.uint64(ends - 1)).astype(np.int64), minlength=ends) & 1
    return np.uint32(len(values)).tobytes() + np.packbits(odd.astype(np.uint8)).tobytes()


class Sketches:
    """Bounds of what sets have in common: where one has an odd number and another has not, a hash is in one of them only."""

    def __init__(self, drawn: list[bytes]):
        self.n = np.array([np.frombuffer(x, np.uint32, 1)[0] for x in drawn], np.int64)
        words = [np.frombuffer(x, np.uint64, offset=4) for x in drawn]
        self.width = np.array([len(w) for w in words], np.int64)
        self.folded = {}
        for width in np.unique(self.width).tolist():  # with those of twice as many, folded to so many
            at = np.flatnonzero((self.width == width) | (self.width == 2 * width))
            table = np.empty((len(at), width), np.uint64)
            for i, j in enumerate(at):
                table[i] = np.bitwise_xor.reduce(words[j].reshape(-1, width), axis=0)
            place = np.full(len(words), -1)
            place[at] = np.arange(len(at))
            self.folded[width] = place, table

    def most(self, x: int | np.ndarray, others: np.ndarray) -> np.ndarray:
        """The most shingles that set x can have in common with each of the others, or each x with its other."""
        x = np.broadcast_to(x, others.shape)
        out = np.minimum(self.n[x], self.n[others])
        least, wide = np.minimum(self.width[x], self.width[others]), np.maximum(self.width[x], self.width[others])
        least = np.where(wide > 2 * least, 0, least)  # sizes alone keep such sets apart
        for width in np.unique(least[least > 0]).tolist():
            some = np.flatnonzero(least == width)
            place, table = self.folded[width]
            for at in range(0, len(some), step := max(1, COMPARED_WORDS // width)):
                i = some[at : at + step]
                apart = np.bitwise_count(table[place[x[i]]] ^ table[place[others[i]]]).sum(axis=1, dtype=np.int64)
                out[i] = np.minimum(out[i], (self.n[x[i]] + self.n[others[i]] - apart) // 2)
        return out

    def may_link(self, x: int, others: np.ndarray) -> np.ndarray:
        both = self.most(x, others)
        return 100 * both >= 75 * (self.n[x] + self.n[others] - both)


def least_hashes(values: np.ndarray) -> np.ndarray:
    """The least of a set's sorted hashes in each range that has any."""
    edge = np.arange(1 << RANGE_BITS, dtype=np.uint64) << np.uint64(64 - RANGE_BITS)
    return values[np.unique(np.searchsorted(values, edge)[: 1 << RANGE_BITS].clip(max=len(values) - 1))] if len(values) else values


def fetch_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """u, v, text, sketch and least hashes of the nodes' documents, straight from a scan: a filter of bounded size tells which documents
    may be wanted. Some others pass it, more of them the more nodes there are; they are in no candidate pair."""
    wanted = docs.sparkSession.sparkContext.broadcast(_bits(nodes.select(F.xxhash64("doc_id").alias("h"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _passing(batches, wanted.value):
            values, starts, sizes, u, v = _sets(piece)
            drawn = pa.array([sketch(values[a : a + n]) for a, n in zip(starts, sizes)], pa.binary())
            least = pa.array([least_hashes(values[a : a + n]).view(np.int64) for a, n in zip(starts, sizes)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [_signed(u), _signed(v), piece.column("text"), drawn, least], ["u", "v", "text", "sketch", "least"]
            )

    schema = "u long, v long, text string, sketch binary, least array<bigint>"
    return docs.select(F.xxhash64("doc_id").alias("h"), "text").mapInArrow(lean(run), schema)


def _texts_of(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v and text of the sets (u, v), and of a few others that pass the same filter; the rest is not shuffled."""
    wanted = texts.sparkSession.sparkContext.broadcast(_bits(sets.select(F.xxhash64("u", "v").alias("h"))))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _passing(batches, wanted.value):
            yield piece.select(["u", "v", "text"])

    return texts.select(F.xxhash64("u", "v").alias("h"), "u", "v", "text").mapInArrow(lean(passing), "u long, v long, text string")


def index_again(texts: DataFrame, marked: DataFrame) -> DataFrame:
    """key, u, w of the marked sets (u, v), with their own frequent shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=PIECE):
            yield pa.RecordBatch.from_arrays([_signed(_sets(piece)[0])], ["s"])

    own = settle(_texts_of(texts, marked).join(marked, ["u", "v"]).select("text"), "join-marked")
    frequent, times = _most_frequent(own.mapInArrow(lean(run), "s long").groupBy("s").count(), "s", "count")
    return index_prefixes(own, frequent, times)


def _asked(pairs: DataFrame) -> DataFrame:
    """x, y, node: each x with itself (y is -1), and with each that it is to be compared with."""
    own = pairs.select("x").distinct().select("x", F.lit(-1).cast("long").alias("y"), F.col("x").alias("node"))
    return own.union(pairs.select("x", "y", F.col("y").alias("node")))


def verify(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, drawn: DataFrame | None) -> DataFrame:
    """The pairs (x, y) that link. Sketches, if given, rule most others out; then each x's set is made once, and those of its
    candidates one after another."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, b""
        for batch in batches:
            kept = []
            for x, y, own in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "sketch"))):
                if y == -1:
                    now, held = x, own
                elif Sketches([held, own]).may_link(0, np.array([1]))[0]:
                    assert x == now
                    kept.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], pa.int64()) for i in (0, 1)], ["x", "y"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, np.zeros(0, np.uint64)
        for piece in pieces(batches, limit=PIECE):
            out_x, out_y = [], []
            values, starts, sizes, _, _ = _sets(piece)
            for x, y, start, size in zip(piece.column("x").to_pylist(), piece.column("y").to_pylist(), starts, sizes):
                own = values[start : start + size]
                if y == -1:
                    now, held = x, own.copy()
                    continue
                assert x == now
                both = int(_within(own, held).sum())
                if 100 * both >= 75 * (size + len(held) - both):
                    out_x.append(x)
                    out_y.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(out_x, pa.int64()), pa.array(out_y, pa.int64())], ["x", "y"])

    def by_x(rows: DataFrame, run) -> DataFrame:
        return rows.repartition("x").sortWithinPartitions("x", "y").mapInArrow(lean(run), "x long, y long").distinct()

    if drawn is not None:
        pairs = settle(by_x(_asked(pairs).join(drawn, "node").select("x", "y", "sketch"), compare), "join-possible")
    asked = settle(_asked(pairs).join(nodes.select("node", "u", "v"), "node").drop("node"), "join-asked")
    some = _texts_of(texts, asked)
    return by_x(some.join(asked, ["u", "v"]).select("x", "y", "text"), decide)


def components(links: DataFrame) -> DataFrame:
    """node, comp (the smallest node reachable) of the nodes that have links, by alternating stars."""
    edges = settle(links.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "links")
    while True:
        both = edges.union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m"))
        least = least.select("x", F.least("x", "m").alias("m"))
        # every larger neighbour goes to the smallest of the neighbours and the node itself
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = large.union(least.where("m < x").select("x", F.col("m").alias("y"))).where("x <> y").distinct()
        large = settle(large, "links")
        # every smaller neighbour goes to the smallest of them
        small = large.groupBy("x").agg(F.min("y").alias("m"))
        moved = large.join(small, "x").where("y > m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        then = settle(moved.union(small.select("x", F.col("m").alias("y"))).distinct(), "links")
        if _same(edges, then):
            break
        edges = then
    roots = edges.select(F.col("y").alias("node")).distinct()
    return edges.select(F.col("x").alias("node"), F.col("y").alias("comp")).union(roots.select("node", F.col("node").alias("comp")))


def _same(a: DataFrame, b: DataFrame) -> bool:
    def total(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())

    return total(a) == total(b)


def _likeliest(drawn: DataFrame) -> DataFrame:
    """Pairs (x, y) of each node with that one which shares most of its least hashes, of those that are the smallest node with
    one of them; one pair at most for each y."""
    keys = drawn.select("node", F.explode("least").alias("key")).distinct()
    first = keys.groupBy("key").agg(F.min("node").alias("x"))
    shared = keys.join(first, "key").where("node > x").groupBy(F.col("node").alias("y"), "x").agg(F.count("*").alias("c"))
    return shared.groupBy("y").agg(F.max_by("x", F.struct("c", -F.col("x"))).alias("x")).select("x", "y")


def _blocks(members: DataFrame, drawn: DataFrame, best: int | None) -> DataFrame:
    """x, y, cut: pairs (x, y) of groups' members that are of different components and may be similar by their sketches, for
    each x that is to be looked at again; with `best`, the so many likeliest in a task, and whether an x has more (cut).

    Groups with the same largest component are worked off together, so a pair of many groups is looked at once. Members
    of such a bundle are dealt into blocks of bounded size, and a task has two blocks at most. Those of the largest component
    have blocks of their own, which meet the others only. Where the groups have about as many rows as there are pairs of
    members, any two members are compared and the groups stay behind.
    """
    counts = members.groupBy("g", "comp").agg(F.count("*").alias("c"))
    bundle = counts.groupBy("g").agg(F.max_by("comp", F.struct("c", "comp")).alias("bundle"))
    rows = members.join(bundle, "g")
    each = rows.groupBy("bundle", "node", "comp").agg(F.max("again").alias("again"), F.count("*").alias("times"))
    sizes = each.groupBy("bundle").agg(
        F.count("*").alias("m"), F.count_if(F.col("comp") == F.col("bundle")).alias("home"), F.sum("times").alias("times")
    )
    parts = sizes.select(
        "bundle",
        (F.col("m") * F.col("m") <= PAIRS_A_ROW * F.col("times")).alias("whole"),
        F.expr(f"if(m <= {BLOCK_NODES}, 0, cast(ceil(home / {BLOCK_NODES}) as int))").alias("homes"),
        F.expr(f"if(m <= {BLOCK_NODES}, 1, cast(ceil((m - home) / {BLOCK_NODES}) as int))").alias("others"),
    )
    hashed = "cast(pmod(xxhash64(node), {}) as int)".format
    block = F.expr(f"if(comp = bundle and homes > 0, {hashed('homes')}, homes + {hashed('others')})")
    spread = F.expr(
        "explode(transform(sequence(if(block < homes, homes, 0), homes + others - 1), "
        "t -> xxhash64(bundle, least(block, t), greatest(block, t))))"
    )
    none = F.lit(None)
    own = each.join(parts, "bundle").withColumn("block", block).join(drawn.select("node", "sketch"), "node")
    own = own.select(spread.alias("key"), none.cast("long").alias("g"), "node", "block", "comp", "again", "sketch")
    grouped = rows.join(parts.where("not whole"), "bundle").withColumn("block", block)
    grouped = grouped.select(
        spread.alias("key"),
        "g",
        "node",
        "block",
        none.cast("long").alias("comp"),
        none.cast("boolean").alias("again"),
        none.cast("binary").alias("sketch"),
    )

    def solve(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows)
        own = table.filter(pa.compute.is_null(table["g"]))
        order = np.lexsort((own["node"].to_numpy(), own["key"].to_numpy()))
        key, node, block, comp, again = (own[c].to_numpy()[order] for c in ("key", "node", "block", "comp", "again"))
        held = own["sketch"].to_pylist()
        sketches = Sketches([held[i] for i in order])
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(key))))
        across = (np.maximum.reduceat(block, start) != np.minimum.reduceat(block, start))[of]
        some = table.filter(pa.compute.is_valid(table["g"]))
        g, its = some["g"].to_numpy(), np.searchsorted(key[start], some["key"].to_numpy())
        every = np.unique(node)
        at = np.searchsorted(of * len(every) + np.searchsorted(every, node), its * len(every) + np.searchsorted(every, some["node"].to_numpy()))
        edge = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (its[1:] != its[:-1])])) if len(g) else np.zeros(0, np.int64)
        whole = np.setdiff1d(np.arange(len(start)), its)
        together = np.zeros((len(node), len(node)), bool)
        for low, high in zip(start[whole], np.append(start[1:], len(key))[whole]):
            together[low:high, low:high] = True
        for low, high in zip(edge, np.append(edge[1:], len(g))):
            if high - low > 1:
                together[np.ix_(at[low:high], at[low:high])] = True
        for low in range(0, len(node), step := max(1, COMPARED_WORDS // len(node))):
            x, y = np.nonzero(np.triu(together[low : low + step], low + 1))
            x = x + low
            may = (comp[x] != comp[y]) & again[x] & ~(across[x] & (block[x] == block[y]))  # pairs within a block are another task's
            may &= 4 * np.minimum(sketches.n[x], sketches.n[y]) >= 3 * np.maximum(sketches.n[x], sketches.n[y])
            x, y = x[may], y[may]
            both = sketches.most(x, y)
            all_of = sketches.n[x] + sketches.n[y] - both
            may = 100 * both >= 75 * all_of
            x, y, alike = x[may], y[may], (both / all_of)[may]
            order = np.lexsort((y, -alike, x))
            x, y = x[order], y[order]
            first = np.searchsorted(x, x)
            cut = np.searchsorted(x, x, side="right") - first > (best or len(x))
            kept = np.arange(len(x)) - first < (best or len(x))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (node[x[kept]], node[y[kept]], cut[kept])], ["x", "y", "cut"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now, nodes = None, 0
        for batch in batches:
            key = batch.column("key").to_numpy()
            edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
            own = np.concatenate([[0], np.cumsum(batch.column("g").is_null().to_numpy(zero_copy_only=False))])
            since = 0
            for low, high in zip(edge, np.append(edge[1:], len(key))):
                if nodes >= SOLVED_NODES and key[low] != now:
                    yield from solve([*held, batch.slice(since, low - since)])
                    held, nodes, since = [], 0, low
                now = key[low]
                nodes += int(own[high] - own[low])
            held.append(batch.slice(since))
        if nodes:
            yield from solve(held)

    dealt = own.union(grouped).repartition("key").sortWithinPartitions("key", F.asc_nulls_first("g"))
    return dealt.mapInArrow(lean(run), "x long, y long, cut boolean").groupBy("x", "y").agg(F.max("cut").alias("cut"))


def connect(members: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """node, comp of all nodes with links."""
    drawn = nodes.select("u", "v", "node").join(texts.select("u", "v", "sketch", "least"), ["u", "v"])
    drawn = settle(drawn.dropDuplicates(["node"]).select("node", "sketch", "least"), "join-drawn")
    pairs = settle(_likeliest(drawn), "join-likeliest")
    links = settle(verify(pairs, nodes, texts, drawn), "join-links")
    tried, left, again = pairs, members, None
    comps = settle(components(links), "join-components")
    for turn in ("best", "all"):
        # groups within one component are done at any time
        now = left.select("g", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        now = now.withColumn("again", F.lit(True)) if again is None else now.join(again, "node", "left").na.fill(False, ["again"])
        some = now.groupBy("g").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.max("again").alias("any"))
        left = settle(now.join(some.where("a <> b and any").select("g"), "g"), "join-open")
        if left.isEmpty():
            break
        found = settle(_blocks(left, drawn, BEST if turn == "best" else None), f"join-{turn}")
        again = found.where("cut").select(F.col("x").alias("node"), F.lit(True).alias("again")).distinct()
        pairs = settle(found.join(tried, ["x", "y"], "left_anti").select("x", "y"), "join-untried")
        tried = tried.union(pairs)
        linked = settle(verify(pairs, nodes, texts, None), "join-links")
        if not linked.isEmpty():
            links = links.union(linked)
            comps = settle(components(links), "join-components")
        if again.isEmpty():  # every set has been compared with all that its sketch didn't rule out
            break
    return comps


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every document, and what tells rows and components apart where ids repeat or are
    null: a hash of the text (xxhash64) and two numbers of the component (null for sets without shingles)."""
    docs = keyed_texts(docs, id_col, text_col)
    rows, frequent, times = describe(docs)
    found = settle(group_members(index_prefixes(docs, frequent, times), MOST_MEMBERS), "join-groups")
    marks = found.where("g is null").select("u", "v").distinct().withColumn("marked", F.lit(True))
    nodes = found.select("u", "v").distinct().join(marks, ["u", "v"], "left")
    one = rows.where("n > 0").groupBy("u", "v").agg(F.min("doc_id").alias("doc_id"))
    nodes = nodes.join(one, ["u", "v"]).select("u", "v", "doc_id", F.coalesce("marked", F.lit(False)).alias("marked"))
    nodes = settle(settle(nodes, "join-nodes").withColumn("node", F.monotonically_increasing_id()), "join-nodes")
    texts = settle(fetch_texts(docs, nodes), "join-texts")
    members = found.where("g is not null").select("g", "u", "v", "n")
    marked = nodes.where("marked").select("u", "v")
    if not marked.isEmpty():
        members = members.union(group_members(index_again(texts, marked), None))
    members = members.join(nodes, ["u", "v"]).select("g", "node")
    comps = connect(settle(members, "join-members"), nodes, texts)
    named = rows.join(nodes.select("u", "v", "node"), ["u", "v"], "left").join(comps, "node", "left")
    named = named.select("doc_id", "text_hash", "n", F.coalesce("comp", "node").alias("c"), "u", "v")
    # a set that shares no group is a component of its own, told by its hashes
    keyed = settle(
        named.select(
            "doc_id",
            "text_hash",
            "n",
            F.when(F.col("c").isNull(), F.col("u")).otherwise(F.col("c")).alias("c"),
            F.when(F.col("c").isNull(), F.col("v")).otherwise(F.lit(-1)).alias("d"),
        ),
        "join-named",
    )
    least = keyed.where("n > 0").groupBy("c", "d").agg(F.min("doc_id").alias("component_id"))
    linked = keyed.where("n > 0").join(least, ["c", "d"])
    linked = linked.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash", "c", "d")
    none = F.lit(None).cast("long")
    alone = keyed.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "text_hash", none.alias("c"), none.alias("d")
    )
    return linked.union(alone)
