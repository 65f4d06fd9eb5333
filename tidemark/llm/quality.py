"""Quality rules with n-gram perplexity bands for each language.

A document has two perplexities, both over all its characters, by modified Kneser-Ney estimates (three discounts for each
order, continuation counts below the highest) from the n-grams of all documents. One is of its characters as they are, each
a code point of its own. That model grows with the corpus: its grams are counted, discounted and given their probabilities
in Spark. Up to `HELD_GRAMS` of them are sent to all tasks; more are joined with the grams of each piece of the documents, so
that no task holds the model whole. The other is of the text's shape: characters folded into 40 classes (the letters a to z
whatever their case, eight classes of other letters, digits, spaces, line breaks, kinds of marks), at most 40^4 entries.

A language's band of either is its quartiles of log perplexity, over all documents that pass the plain rules, widened by
`reach` times their distance on either side; documents outside one of them are rejected.

Null and empty texts have no words and fail the plain rules, as do all of fewer than 50 words. A null language is a
language of its own; languages of under `least_docs` documents share the band of all documents. Every row of the input
has a row of the result.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.documents import kept, lean, pieces, ship
from tidemark.sources.staging import settle

CLASSES = 40
ORDER = 4
#: Bits of a whole character, and how many there are.
POINT_BITS, POINTS = 21, 0x110000
#: Grams of whole characters that all tasks hold, and text bytes whose grams' probabilities are joined at a time if there are more.
HELD_GRAMS, JOINED_BYTES = 1 << 21, 32 << 20
SYMBOLS = "#*$%&|<>"
REACH = 4.0
LEAST_DOCS = 100
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, log_ppl double,"
    " shape_ppl double"
)


def _class(point: int) -> int:
    c = chr(point)
    if c.lower() in "abcdefghijklmnopqrstuvwxyz" and point < 128:
        return 1 + ord(c.lower()) - 97
    if c.isalpha():
        return 32 + ord(c.lower()[0]) % 8
    if c.isdigit():
        return 27
    if c == "\n":
        return 28
    if c.isspace():
        return 0
    if c in ".,;:!?":
        return 29
    return 30 if point < 128 else 31


def _class_table() -> np.ndarray:
    """The classes of the first 65,536 code points; those beyond are rare and classed as they come."""
    return np.array([_class(x) for x in range(65_536)], np.uint8)


def _classes(points: np.ndarray) -> np.ndarray:
    if not _table:
        _table.append(_class_table())
    out = _table[0][np.minimum(points, 65_535)].astype(np.int32)
    beyond = np.flatnonzero(points > 65_535)
    if len(beyond):
        distinct, at = np.unique(points[beyond], return_inverse=True)
        out[beyond] = np.array([_class(int(x)) for x in distinct], np.int32)[at]
    return out


_table: list[np.ndarray] = []


def _points(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of the texts, each after as many spaces as a gram of its first character reaches back; which of the grams
    end in a text; and where each text's characters end."""
    pad = " " * (order - 1)  # a text starts as after spaces
    points = np.frombuffer(pad.join(["", *texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(x) for x in texts], np.int64)
    keep = np.ones(len(points) - order + 1, bool)
    gap = np.cumsum(sizes)[:-1] + (order - 1) * np.arange(len(texts) - 1)
    for back in range(order - 1):
        keep[gap + back] = False
    return points, keep, np.cumsum(sizes)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code of the 4-gram that ends at each character of the texts, and where each text's characters end."""
    points, keep, ends = _points(texts, ORDER)
    classes = _classes(points)
    codes = classes[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        codes += classes[ORDER - 1 - back : len(classes) - back] * np.int32(CLASSES**back)
    return codes[keep], ends


def _packed(values: np.ndarray, order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All but the last two, and the last two, of each `order` values in a row, `bits` bits each."""
    size, shift = len(values) - order + 1, np.int64(bits)
    head, last = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for i in range(order):
        part = head if i < order - 2 else last
        part <<= shift
        part |= values[i : i + size]
    return head, last


def whole_grams(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The gram of whole characters that ends at each character of the texts, in two parts: `head`, all but its last two, and
    `last`, those; and where each text's characters end."""
    points, keep, ends = _points(texts, order)
    head, last = _packed(points, order, POINT_BITS)
    return head[keep], last[keep], ends


def distinct_grams(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`head` and `last` of each distinct gram of whole characters, and how often it comes."""
    points, keep, _ = _points(texts, order)
    kinds = np.flatnonzero(np.bincount(points))
    number = np.zeros(int(kinds[-1]) + 1 if len(kinds) else 1, np.int64)
    number[kinds] = np.arange(len(kinds))
    bits = max(1, (len(kinds) - 1).bit_length())
    if order * bits <= 63:  # numbered within the texts, a gram is one number
        head, last = _packed(number[points], order, bits)
        head <<= np.int64(2 * bits)
        head |= last
        found, count = np.unique(head[keep], return_counts=True)
        parts = [kinds[(found >> np.int64(bits * (order - 1 - i))) & np.int64((1 << bits) - 1)] for i in range(order)]
        head, last = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        for i, x in enumerate(parts):
            part = head if i < order - 2 else last
            part <<= np.int64(POINT_BITS)
            part |= x
        return head, last, count
    head, last = (x[keep] for x in _packed(points, order, POINT_BITS))
    heads, at = np.unique(head, return_inverse=True)
    lasts, then = np.unique(last, return_inverse=True)
    found, count = np.unique(at * np.int64(len(lasts)) + then, return_counts=True)
    return heads[found // len(lasts)], lasts[found % len(lasts)], count


def count_grams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`gram` and `count` over all documents; a task adds its own up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES**ORDER, np.int64)
        for piece in pieces(batches):
            codes, _ = grams([x or "" for x in piece.column("text").to_pylist()])
            counts += np.bincount(codes, minlength=len(counts))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], ["gram", "count"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), "gram int, count long")
    return counted.groupBy("gram").agg(F.sum("count").alias("count"))


def count_whole(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> DataFrame:
    """`head`, `last` and `count` of the grams of whole characters of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = distinct_grams([x or "" for x in piece.column("text").to_pylist()], order)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["head", "last", "count"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), "head long, last long, count long")
    return counted.groupBy("head", "last").agg(F.sum("count").alias("count"))


def _tail(order: int) -> tuple[Column, Column]:
    """`head` and `last` of a gram of that order without its first character."""
    low = (1 << POINT_BITS * max(0, order - 3)) - 1
    last = F.col("last") if order > 2 else F.col("last").bitwiseAND(F.lit((1 << POINT_BITS) - 1))
    return F.col("head").bitwiseAND(F.lit(low)), last


def _cuts(n: list[float]) -> list[float]:
    """The discounts of counts of one, two, and more, from how many grams come once, twice, three and four times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    return [min(0.95 * k, max(0.05, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] else 0.5 for k in (1, 2, 3)]


def whole_logs(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """`head`, `last` and `log`: of each counted gram, the natural logarithm of the modified Kneser-Ney probability of its last
    character after those before it. Below the first order all code points are alike."""
    tables = {order: counted}
    for k in range(order - 1, 0, -1):  # how many characters come before a gram
        head, last = _tail(k + 1)
        tails = tables[k + 1].select(head.alias("head"), last.alias("last")).groupBy("head", "last").agg(F.count("*").alias("count"))
        tables[k] = settle(tails, "quality-tails")
    lower = None
    for k in range(1, order + 1):
        of = [F.count(F.when(F.col("count") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]
        n = tables[k].agg(*of, F.count("*").alias("kinds"), F.coalesce(F.sum("count"), F.lit(0)).alias("total")).first()
        cut = _cuts([float(n[f"n{i}"]) for i in (1, 2, 3, 4)])
        rows = tables[k].withColumn("cut", F.when(F.col("count") == 1, cut[0]).when(F.col("count") == 2, cut[1]).otherwise(cut[2]))
        if k == 1:
            spare = cut[0] * n.n1 + cut[1] * n.n2 + cut[2] * (n.kinds - n.n1 - n.n2)
            rows = rows.withColumns({"total": F.lit(n.total), "spare": F.lit(float(spare)), "below": F.lit(1 / POINTS)})
        else:
            rows = rows.withColumn("before", F.shiftright("last", POINT_BITS))
            contexts = rows.groupBy("head", "before").agg(F.sum("count").alias("total"), F.sum("cut").alias("spare"))
            head, last = _tail(k)
            rows = rows.join(contexts, ["head", "before"]).withColumns({"tail_head": head, "tail_last": last}).join(lower, ["tail_head", "tail_last"])
        p = ((F.col("count") - F.col("cut")) + F.col("spare") * F.col("below")) / F.col("total")
        found = rows.select("head", "last", p.alias("p"))
        lower = found.select(F.col("head").alias("tail_head"), F.col("last").alias("tail_last"), F.col("p").alias("below"))
    return found.select("head", "last", F.log("p").cast("float").alias("log"))


def _keys(head: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of grams of whole characters."""
    with np.errstate(over="ignore"):
        x = head.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x += last.astype(np.uint64)
        x *= np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x9E3779B97F4A7C15)
    return x


class Logs:
    """Logarithms by gram: slots by the first bits of the grams' hashes, and a sorted array of those whose slot another has."""

    def __init__(self, head: np.ndarray, last: np.ndarray, logs: np.ndarray):
        keys = _keys(head, last)
        self.shift = np.uint64(64 - max(1, (2 * len(keys)).bit_length()))
        slot = keys >> self.shift
        owner = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        owner[slot] = np.arange(len(keys), dtype=np.int32)
        self.keys, self.logs = np.zeros(len(owner), np.uint64), np.zeros(len(owner), np.float32)
        taken = owner >= 0
        self.keys[taken], self.logs[taken] = keys[owner[taken]], logs[owner[taken]]
        left = np.flatnonzero(owner[slot] != np.arange(len(keys)))
        left = left[np.argsort(keys[left])]
        self.left_keys, self.left_logs = keys[left], logs[left]

    def __call__(self, head: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of grams that were all counted."""
        keys = _keys(head, last)
        slot = keys >> self.shift
        out = self.logs[slot]
        other = np.flatnonzero(self.keys[slot] != keys)
        if len(other):
            at = np.searchsorted(self.left_keys, keys[other])
            if (at == len(self.left_keys)).any() or (self.left_keys[at] != keys[other]).any():
                raise ValueError("The documents have n-grams that were not counted: they changed between two readings.")
            out[other] = self.left_logs[at]
        return out


def _hash(codes: np.ndarray, order: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (codes.astype(np.uint64) + np.uint64(order << 40)) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))


class Hashed:
    """Values by code, in arrays sorted by the codes' hashes."""

    def __init__(self, codes: np.ndarray, values: np.ndarray, order: int):
        keys = _hash(codes, order)
        by = np.argsort(keys)
        self.keys, self.values, self.order = keys[by], values[by], order

    def __call__(self, codes: np.ndarray, missing: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(codes), missing)
        keys = _hash(codes, self.order)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], missing)


class KneserNey:
    """Interpolated modified Kneser-Ney probabilities of the last class of a gram, given the ones before it."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        by_order = {ORDER: (codes.astype(np.int64), counts.astype(np.float64))}
        for order in range(ORDER - 1, 0, -1):  # how many classes come before a gram
            above = by_order[order + 1][0]
            tails, kinds = np.unique(above % CLASSES**order, return_counts=True)
            by_order[order] = tails, kinds.astype(np.float64)
        self.prob: dict[int, Hashed] = {}
        self.back: dict[int, Hashed] = {}
        for order in range(1, ORDER + 1):
            codes, counts = by_order[order]
            cut = _cuts([float((counts == k).sum()) for k in (1, 2, 3, 4)])
            discount = np.select([counts == 1, counts == 2], cut[:2], cut[2])
            contexts, at = np.unique(codes // CLASSES, return_inverse=True)
            total = np.bincount(at, counts, minlength=len(contexts))
            spare = np.bincount(at, discount, minlength=len(contexts)) / np.maximum(total, 1e-300)
            below = self._probability(codes % CLASSES ** (order - 1), order - 1) if order > 1 else np.full(len(codes), 1 / CLASSES)
            self.back[order] = Hashed(contexts, spare, order)
            self.prob[order] = Hashed(codes, (counts - discount) / total[at] + spare[at] * below, order)
        self.known = np.full(CLASSES**ORDER, np.nan, np.float32)

    def _probability(self, codes: np.ndarray, order: int) -> np.ndarray:
        if order == 0:
            return np.full(len(codes), 1 / CLASSES)
        out = self.prob[order](codes, -1.0)
        new = out < 0
        if new.any():
            lower = self._probability(codes[new] % CLASSES ** (order - 1), order - 1)
            out[new] = self.back[order](codes[new] // CLASSES, 1.0) * lower
        return out

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """Natural logarithms; each code is looked up in the arrays once and then kept."""
        out = self.known[codes]
        if np.isnan(out).any():
            new = np.unique(codes[np.isnan(out)])
            self.known[new] = np.log(self._probability(new.astype(np.int64), ORDER))
            out = self.known[codes]
        return out


def fit(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of all n-grams: 40^4 of them at most."""
    table = count_grams(docs, text_col).toArrow()
    codes, counts = table["gram"].to_numpy(), table["count"].to_numpy()
    by = np.argsort(codes)
    return codes[by], counts[by]


def measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode().split()  # at ASCII white space alone
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    repeated = 0
    if n > 2:
        windows = list(zip(words, words[1:], words[2:]))
        distinct = set(windows)
        if len(distinct) < len(windows):
            often = {w for w, k in Counter(windows).items() if k > 1}
            until = 0  # the first word not yet counted
            for i, w in enumerate(windows):
                if w in often:
                    repeated += i + 3 - max(i, until)
                    until = i + 3
    return n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def _mean(logs: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The mean log perplexity of each text from its characters' logarithms."""
    sums = np.concatenate([[0.0], np.cumsum(logs.astype(np.float64))])
    sizes = np.diff(ends, prepend=0)
    return (sums[ends - sizes] - sums[ends]) / np.maximum(sizes, 1)


def _measured(piece: pa.RecordBatch, shape: KneserNey, whole: Logs) -> pa.RecordBatch:
    """`row`, `lang`, `text` and `q` of the rows of a piece."""
    texts = [x or "" for x in piece.column("text").to_pylist()]
    codes, ends = grams(texts)
    shapes = _mean(shape.log_probability(codes), ends)
    del codes
    head, last, ends = whole_grams(texts)
    mean = _mean(whole(head, last), ends)
    found = np.array([measures(x) for x in texts], np.int64).reshape(-1, 5)
    failed = (found[:, 0] < 50) | (100 * found[:, 4] > 50 * found[:, 0])
    columns = [*(pa.array(found[:, i]) for i in range(5)), pa.array(failed), pa.array(mean), pa.array(shapes)]
    q = pa.StructArray.from_arrays(columns, [x.split()[0] for x in MEASURES.split(", ")])
    return pa.RecordBatch.from_arrays([piece.column("row"), piece.column("lang"), piece.column("text"), q], ["row", "lang", "text", "q"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about `JOINED_BYTES`, each a row of arrays: the texts in turn, compressed, with how many bytes each
    has, -1 for a null."""
    task, size, number = TaskContext.get().partitionId() << 33, 0, 0
    held: list[pa.RecordBatch] = []

    def whole() -> pa.RecordBatch:
        nonlocal size, number
        columns = {c: pa.concat_arrays([x.column(c) for x in held]) for c in ("row", "lang", "text")}
        raw = b"".join(x.encode() for x in columns["text"].to_pylist() if x)
        columns["text"] = pa.compute.fill_null(pa.compute.binary_length(columns["text"]), -1).cast(pa.int64())
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in columns.values()]
        text = pa.Codec("zstd", compression_level=9).compress(raw, asbytes=True)  # stored once and shuffled once
        number, size = number + 1, 0
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([task + number]), *lists, pa.array([text], pa.binary())], ["piece", "row", "lang", "size", "text"])

    for piece in pieces(batches):
        held.append(piece)
        size += piece.column("text").nbytes
        if size >= JOINED_BYTES:
            yield whole()
    if held:
        yield whole()


def _uncut(batch: pa.RecordBatch, i: int) -> Iterator[pa.RecordBatch]:
    """`row`, `lang` and `text` of one such piece, a part at a time."""
    sizes = batch.column("size")[i].values.to_numpy()
    ends = np.cumsum(np.maximum(sizes, 0)).tolist()
    raw = pa.Codec("zstd").decompress(batch.column("text")[i].as_py(), ends[-1], asbytes=True)
    texts = pa.array([raw[x:y] if n >= 0 else None for x, y, n in zip([0, *ends], ends, sizes.tolist())], pa.binary()).cast(pa.string())
    columns = [batch.column("row")[i].values, batch.column("lang")[i].values, texts]
    return pieces(iter([pa.RecordBatch.from_arrays(columns, ["row", "lang", "text"])]))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct grams of whole characters of each piece."""
    for batch in batches:
        for i, number in enumerate(batch.column("piece").to_pylist()):
            found = [distinct_grams([x or "" for x in part.column("text").to_pylist()])[:2] for part in _uncut(batch, i)]
            head, last = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((last, head))
            head, last = head[order], last[order]
            new = np.ones(len(head), bool)
            new[1:] = (head[1:] != head[:-1]) | (last[1:] != last[:-1])
            columns = [pa.array(np.full(int(new.sum()), number)), pa.array(head[new]), pa.array(last[new])]
            yield pa.RecordBatch.from_arrays(columns, ["piece", "head", "last"])


def _beside_logs(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The rows in pieces, and before each piece the grams that it has with their logarithms."""
    kind = rows.schema["row"].dataType.simpleString()
    schema = f"piece long, row array<{kind}>, lang array<string>, size array<long>, text binary"
    cut = settle(rows.mapInArrow(lean(_cut), schema), "quality-pieces")
    wanted = cut.mapInArrow(lean(_asked), "piece long, head long, last long")
    both = cut.unionByName(wanted.join(table, ["head", "last"]), allowMissingColumns=True)
    return both.repartition("piece").sortWithinPartitions("piece", F.col("head").isNull())


def measure(docs: DataFrame, carry: list[str], text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """`row` (a struct of the carried columns), `lang`, `text`, and `q`: the measures and the mean log perplexities of each
    row."""
    ship(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    counted, name = context.broadcast(fit(docs, text_col)), uuid.uuid4().hex
    table = settle(whole_logs(settle(count_whole(docs, text_col), "quality-grams")), "quality-logs")
    rows = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    kind = rows.schema["row"].dataType.simpleString()
    schema = f"row {kind}, lang string, text string, q struct<{MEASURES.replace(' ', ':').replace(',:', ',')}>"

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = kept(name, lambda: KneserNey(*counted.value))
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))  # a piece may have no character
        given = [empty]
        for batch in batches:
            start = 0
            for i in [*np.flatnonzero(batch.column("head").is_null().to_numpy(zero_copy_only=False)).tolist(), batch.num_rows]:
                given.append([batch.column(c).slice(start, i - start).to_numpy() for c in ("head", "last", "log")])
                if (start := i + 1) > batch.num_rows:
                    break
                logs, given = Logs(*map(np.concatenate, zip(*given))), [empty]
                for piece in _uncut(batch, i):
                    yield _measured(piece, shape, logs)

    if table.count() > HELD_GRAMS:
        return _beside_logs(rows, table).mapInArrow(lean(beside), schema)
    found = table.toArrow()
    held = context.broadcast([found[c].to_numpy() for c in ("head", "last", "log")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, whole = kept(name, lambda: (KneserNey(*counted.value), Logs(*held.value)))
        for piece in pieces(batches):
            yield _measured(piece, shape, whole)

    return rows.mapInArrow(lean(run), schema)


def judge(
    docs: DataFrame, carry: list[str], with_text: bool = False, reach: float = REACH, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """`row`, `q` and `kept` of every document, and its `text` if wanted."""
    measured = measure(docs, carry)
    if with_text:  # measured again where it is used, so that no text is stored for the bands
        rows, measures = measured, settle(measured.select("lang", "q"), "quality")
    else:
        rows = measures = settle(measured.drop("text"), "quality")
    passed = measures.where("not q.base_failed")
    perplexities = ("log_ppl", "shape_ppl")
    quartiles = F.struct(*[F.percentile_approx(f"q.{x}", F.array(F.lit(0.25), F.lit(0.75)), 10_000).alias(x) for x in perplexities])
    by_lang = passed.groupBy("lang").agg(quartiles.alias("own"), F.count("*").alias("n"))
    every = passed.agg(quartiles.alias("every")).first().every
    every = F.struct(*[F.array(*[F.lit(y).cast("double") for y in every[x] or (None, None)]).alias(x) for x in perplexities])
    bands = by_lang.select("lang", F.when(F.col("n") >= least_docs, F.col("own")).otherwise(every).alias("b"))
    edges = [f"b.{x}[{i}] {'-+'[i]} {reach} * (b.{x}[1] - b.{x}[0]) {x}_{i}" for x in perplexities for i in (0, 1)]
    bands = settle(bands.selectExpr("lang", *edges), "quality-bands")  # of known size, so a few languages are joined without a shuffle
    within = " and ".join(f"q.{x} between {x}_0 and {x}_1" for x in perplexities)
    verdict = F.expr(f"not q.base_failed and coalesce({within}, false)")
    return rows.join(bands, "lang", "left").withColumn("kept", verdict).drop("lang", *[f"{x}_{i}" for x in perplexities for i in (0, 1)])


def quality(docs: DataFrame, id_col: str = "doc_id", reach: float = REACH) -> DataFrame:
    """doc_id, the measures, base_failed and kept of every document, then its mean log perplexity for each character as it is."""
    judged = judge(docs.withColumn(id_col, F.col(id_col).cast("long")), [id_col], reach=reach)
    return judged.select(
        F.col(f"row.{id_col}").alias("doc_id"),
        *[F.col(f"q.{x}") for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")],
        "kept",
        F.col("q.log_ppl").alias("log_ppl"),
    )
