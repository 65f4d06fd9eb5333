"""Periodic runs of words: maximal stretches that repeat with a period at least MIN_EXPONENT times.

A document's words get numbers, and it is exploded into overlapping tiles for each octave of periods [P, 2P): the more words,
the longer the period. A tile has a boundary at every 2P words. The words that equal the word one period on form stretches;
one of a run of period q has 3q words or more, so it holds a boundary. There, Z-functions to the right and to the left (how
far the words from the boundary equal those from q further, capped at 6P) give the stretch for all q of the octave at once.
Boundaries whose next P words have no equal at a distance of [P, 2P) are passed over by comparing hashes of P words, which
never miss an equal. For periods under SHORT, all boundaries' Z values come from one comparison of the tile with itself.

Tiles are solved independently: a stretch that a tile cuts or caps is seen from the next boundary too, with an overlap.
Fragments are shuffled by document and period and stitched where their stretches touch; a stretch found for a multiple of its
least period is dropped. Runs then go to their documents for the digests.

Tiles of a text of over SPREAD_BYTES are shuffled, as word numbers, before they are solved; those of others are solved where
the text is read, many together, which gives the same fragments. The text of one document is split by one task; all else is bounded by tiles. Equal rows are solved once and each has its row of
the result. Null and empty texts have no words and no runs. A null id counts as the empty text in the id's checksum. An empty
table gives an empty result. Columns other than the two are dropped, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.documents import keyed_texts, pieces
from tidemark.sources.staging import settle

MIN_EXPONENT = 4
LEAST_WORDS = 6
#: Periods solved by comparing a tile with itself; a power of two.
SHORT = 32
#: A tile's own words: TILE_WORDS, or CORE times the least period of its octave if that is more.
TILE_WORDS = 32_768
CORE = 16
#: In least periods: the cap of the Z-functions, and the words on either side of a tile's own.
REACH = 6
HALO = 8
#: Tiles of texts of more bytes are shuffled before they are solved.
SPREAD_BYTES = 1 << 20

KEY = "k1 long, k2 long"
TILES = f"{KEY}, octave int, first long, words array<int>"
FRAGMENTS = f"{KEY}, period long, start long, stop long"
SCANNED = f"{FRAGMENTS}, doc_id long, text string, plain string"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
DIGESTS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


# --- words ---------------------------------------------------------------------------------


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) where words from a on are made to repeat words a to a+p, as the contract of the query asks; else None."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def words_of(text: str, plant: bool, doc_id: int | None) -> list[bytes]:
    words = text.encode().split()  # at ASCII white space alone
    at = planted(doc_id, len(words)) if plant else None
    if at is not None:
        a, p = at
        root = words[a : a + p]
        words[a:] = (root * (-(-(len(words) - a) // p)))[: len(words) - a]
    return words


def numbered(words: list[bytes]) -> np.ndarray:
    """The words as numbers; equal words have equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))


# --- tiles ---------------------------------------------------------------------------------


def tiles_of(n: int) -> Iterator[tuple[int, int, int]]:
    """(least period, first word, end) of each tile of a document of n words."""
    octave = 1
    while MIN_EXPONENT * octave <= n:
        own, halo = max(TILE_WORDS, CORE * octave), HALO * octave
        for start in range(0, n, own):
            yield octave, max(0, start - halo), min(n, start + own + halo)
        octave *= 2


def z_values(words: np.ndarray, upto: int, cap: int) -> np.ndarray:
    """How many words from each place below `upto` on equal the words from place 0 on, `cap` at most; linear in all."""
    z = np.zeros(upto, np.int64)
    left = right = 0  # the stretch furthest to the right that is known to equal a beginning
    for at in (np.flatnonzero(words[1:upto] == words[0]) + 1).tolist():
        known = min(int(z[at - left]), right - at) if at < right else 0
        if at + known >= right or not right:
            known, step = max(known, 0), 32
            while known < cap:
                here, there = words[known : known + step], words[at + known : at + known + step]
                differ = here[: len(there)] != there
                if differ.any():
                    known += int(differ.argmax())
                    break
                known += len(there)
                if len(there) < step:
                    break
                step *= 2
            if at + known > right:
                left, right = at, at + known
        z[at] = min(known, cap)
    return z


def at_boundary(words: np.ndarray, c: int, octave: int) -> list[tuple[int, int, int]]:
    """(period, start, stop) of the stretches that equal the words one period on and hold word c, for periods of an octave."""
    cap, most = REACH * octave, 2 * octave
    ahead = z_values(words[c : c + cap + most], min(most, len(words) - c), cap)
    likely = octave + np.flatnonzero(ahead[octave:] >= octave)
    if not len(likely):
        return []
    # a root of q words that itself repeats with a divisor of q belongs to the divisor's octave
    roots: list[int] = []
    for short in (np.flatnonzero(ahead[1 : octave + 1] >= np.arange(1, 1 + len(ahead[1 : octave + 1]))) + 1).tolist():
        if any(short % root == 0 and ahead[root] + root >= short for root in roots):
            continue
        roots.append(short)
        likely = likely[(likely % short != 0) | (ahead[short] + short < likely) | (likely == short)]
        if not len(likely):
            return []
    back = words[max(0, c - cap) : c][::-1]
    behind = words[max(0, c - cap) : c + int(likely[-1])][::-1]
    if len(back):
        joined = np.concatenate([back, [-1], behind])
        z = z_values(joined, len(joined), len(back))
        backward = z[len(back) + 1 + int(likely[-1]) - likely]
    else:
        backward = np.zeros(len(likely), np.int64)
    total = ahead[likely] + backward
    return [(int(q), c - int(b), c + int(ahead[q])) for q, b, t in zip(likely, backward, total) if t >= (MIN_EXPONENT - 1) * q]


def short_stretches(words: np.ndarray, octave: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(period, starts, stops) of all stretches that equal the words one period on, for the periods of an octave."""
    for q in range(octave, 2 * octave):
        least = (MIN_EXPONENT - 1) * q
        if len(words) < q + least:
            return
        same = np.zeros(len(words) - q + 2, np.int8)
        same[1:-1] = words[:-q] == words[q:]
        edges = np.flatnonzero(same[1:] != same[:-1])
        starts, stops = edges[::2], edges[1::2]
        long = stops - starts >= least
        if long.any():
            yield q, starts[long], stops[long]


def long_stretches(words: np.ndarray, octave: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The same for longer periods, from the boundaries; a stretch may come once for each of its boundaries."""
    width = 2 * octave
    with np.errstate(over="ignore"):
        mixed = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        powers = np.cumprod(np.full(len(words) + 1, 0xD6E8FEB86659FD93, np.uint64))
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mixed * powers[:-1], out=sums[1:])
        windows = (sums[octave:] - sums[:-octave]) * powers[::-1][: len(sums) - octave]  # shifted to one power
    rows = -(-len(windows) // width)
    table = np.zeros(rows * width, np.uint64)
    table[: len(windows)] = windows
    table = table.reshape(rows, width)
    found: dict[int, list[tuple[int, int]]] = {}
    for i in np.flatnonzero((table[:, octave:] == table[:, :1]).any(axis=1)).tolist():
        for q, start, stop in at_boundary(words, i * width, octave):
            found.setdefault(q, []).append((start, stop))
    for q, parts in found.items():
        starts, stops = np.array(sorted(parts)).T
        new = np.ones(len(starts), bool)
        new[1:] = starts[1:] > np.maximum.accumulate(stops)[:-1]
        first = np.flatnonzero(new)
        yield q, starts[first], np.maximum.reduceat(stops, first)


def solve(words: np.ndarray, octave: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(period, starts, ends) of the stretches of words that repeat with the periods of an octave."""
    for q, starts, stops in short_stretches(words, octave) if octave < SHORT else long_stretches(words, octave):
        yield q, starts, stops + q


class Tiles:
    """Tiles of any documents, solved together octave by octave."""

    def __init__(self) -> None:
        self.by_octave: dict[int, list[tuple[int, int, int, np.ndarray]]] = {}

    def add(self, k1: int, k2: int, octave: int, first: int, words: np.ndarray) -> None:
        self.by_octave.setdefault(octave, []).append((k1, k2, first, words))

    def fragments(self) -> Iterator[pa.RecordBatch]:
        """Stretches by document and period: words `start` to `stop` repeat with the period."""
        for octave, tiles in self.by_octave.items():
            k1, k2, first, words = zip(*tiles)
            ends = np.cumsum([len(x) for x in words])
            begins = ends - [len(x) for x in words]
            # numbers of their own for each tile, so that no stretch goes over an edge
            apart = np.cumsum([0, *(int(x.max()) + 1 for x in words[:-1])])
            joined = np.concatenate([x.astype(np.int64) + a for x, a in zip(words, apart)])
            k1, k2, shift = np.array(k1), np.array(k2), np.array(first) - begins
            for q, starts, stops in solve(joined, octave):
                at = np.searchsorted(ends, starts, side="right")
                columns = [k1[at], k2[at], np.full(len(at), q), starts + shift[at], stops + shift[at]]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["k1", "k2", "period", "start", "stop"])
        self.by_octave = {}


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with 128 bits that stand for id and text: rows equal in both share their runs."""
    rows = keyed_texts(docs)
    return rows.select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("k2")
    )


def _numbered_rows(piece: pa.RecordBatch, plant: bool) -> Iterator[tuple[int, int, list[bytes], np.ndarray]]:
    for row in piece.to_pylist():
        words = words_of(row["text"] or "", plant, row["doc_id"])
        yield row["k1"], row["k2"], words, numbered(words)


def scan(keyed: DataFrame, plant: bool) -> tuple[DataFrame, DataFrame]:
    """Fragments of all documents, and the documents themselves: `plain` is the digest of the words of one without any
    fragment, and null for others, which have their `text`. Texts are read once, and few of them are stored."""

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            tiles, listed, repeating = Tiles(), [], set()
            for k1, k2, words, numbers in _numbered_rows(piece, plant):
                listed.append((k1, k2, words))
                for octave, first, end in tiles_of(len(numbers)):
                    tiles.add(k1, k2, octave, first, numbers[first:end])
            for found in tiles.fragments():
                repeating |= set(zip(found.column("k1").to_pylist(), found.column("k2").to_pylist()))
                nothing = [pa.nulls(len(found), x) for x in (pa.int64(), pa.string(), pa.string())]
                yield pa.RecordBatch.from_arrays([*found.columns, *nothing], names)
            again = [(k1, k2) in repeating for k1, k2, _ in listed]
            plain = [None if x else sha256(b" ".join(words)).hexdigest() for x, (_, _, words) in zip(again, listed)]
            text = [x if held else None for x, held in zip(piece.column("text").to_pylist(), again)]
            keys = [pa.array(x, pa.int64()) for x in list(zip(*listed))[:2]]
            no_stretch = [pa.nulls(len(listed), pa.int64())] * 3
            rest = [piece.column("doc_id"), pa.array(text, pa.string()), pa.array(plain, pa.string())]
            yield pa.RecordBatch.from_arrays([*keys, *no_stretch, *rest], names)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
        for piece in pieces(batches):
            for k1, k2, _, numbers in _numbered_rows(piece, plant):
                for octave, first, end in tiles_of(len(numbers)):
                    row = zip([k1, k2, octave, first, numbers[first:end]], kinds)
                    yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in row], ["k1", "k2", "octave", "first", "words"])

    def there(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a tile at a time
                k1, k2, octave, first = (batch.column(c)[i].as_py() for c in ("k1", "k2", "octave", "first"))
                tile = Tiles()
                tile.add(k1, k2, octave, first, batch.column("words")[i].values.to_numpy())
                yield from tile.fragments()

    names = [x.split()[0] for x in SCANNED.split(", ")]
    large = F.coalesce(F.octet_length("text") > SPREAD_BYTES, F.lit(False))
    read = settle(keyed.where(~large).mapInArrow(here, SCANNED), "periodic-scan")
    tiles = keyed.where(large).mapInArrow(spread, TILES).repartition("k1", "k2", "octave", "first")
    fragments = read.where("period is not null").select("k1", "k2", "period", "start", "stop")
    documents = read.where("period is null").select("doc_id", "k1", "k2", "text", "plain")
    late = keyed.where(large).select("doc_id", "k1", "k2", "text", F.lit(None).cast("string").alias("plain"))
    return fragments.unionByName(tiles.mapInArrow(there, FRAGMENTS)), documents.unionByName(late)


def stitch(fragments: DataFrame) -> DataFrame:
    """Runs of each document from the fragments of its tiles."""
    by_start = fragments.groupBy("k1", "k2", "period", "start").agg(F.max("stop").alias("stop"))
    series = Window.partitionBy("k1", "k2", "period").orderBy("start")
    reached = F.max("stop").over(series.rowsBetween(Window.unboundedPreceding, -1))
    # stretches of equal words, a period shorter than the words they cover, that overlap or touch are one
    apart = F.coalesce(F.col("start") > reached - F.col("period"), F.lit(True)).cast("long")
    marked = by_start.withColumn("apart", apart).withColumn("run", F.sum("apart").over(series))
    whole = marked.groupBy("k1", "k2", "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    length = F.col("stop") - F.col("start")
    whole = whole.where(length >= F.greatest(F.lit(LEAST_WORDS), MIN_EXPONENT * F.col("period")))
    least = whole.groupBy("k1", "k2", "start", "stop").agg(F.min("period").alias("period"))
    runs = F.sort_array(F.collect_list(F.struct("start", length.alias("length"), "period"))).alias("runs")
    return least.groupBy("k1", "k2").agg(runs)


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, start, length and period of every run of every document as it is."""
    fragments, documents = scan(_keyed(docs), plant=False)
    return documents.drop("text", "plain").join(stitch(fragments), ["k1", "k2"]).select("doc_id", F.inline("runs"))


def digests(docs: DataFrame) -> DataFrame:
    """For each document, some of them altered as `planted` says: the number of runs, the run of greatest exponent, and
    digests of all runs and of the text without the words that repeat a run's root."""
    fragments, documents = scan(_keyed(docs), plant=True)
    # merged by key whatever the size, so that growing runs don't change the plan
    joined = documents.where("plain is null").hint("merge").join(stitch(fragments), ["k1", "k2"], "left")
    names = [x.split()[0] for x in DIGESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            rows = []
            for row in piece.to_pylist():
                words = words_of(row["text"] or "", True, row["doc_id"])
                listed = [(x["start"], x["length"], x["period"]) for x in row["runs"] or []]
                best = max(listed, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
                milli = None if best[0] is None else 1000 * best[1] // best[2]
                kept = np.ones(len(words), bool)
                for start, length, period in listed:
                    kept[start + period : start + length] = False
                left = b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in listed)
                rows.append((row["doc_id"], len(listed), *best, milli, sha256(lines.encode()).hexdigest(), sha256(left).hexdigest()))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    none = [F.lit(None).cast("long").alias(x) for x in names[2:6]]
    plain = documents.where("plain is not null").select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), *none, F.sha2(F.lit(b""), 256).alias(names[6]), F.col("plain").alias(names[7])
    )
    return plain.unionByName(joined.select("doc_id", "text", "runs").mapInArrow(run, DIGESTS))
