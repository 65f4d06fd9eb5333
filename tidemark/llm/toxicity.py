"""Toxic spans tagged by a linear-chain conditional random field, and document scores from its marginals.

Labels are of documents; tokens (stretches of letters) are labelled from them: a token of a toxic document is toxic if its
word or its beginning stands in far more toxic than clean documents. Spark counts these over all training documents.
The field has two tags, weights for hashed features of a token (its word, three beginnings, its ending, the words beside it)
and for steps between tags; it is fitted by gradient steps on the exact likelihood of labelled stretches of tokens.

Forward-backward runs over whole documents. As a step multiplies by a 2x2 matrix, pieces of the chain are multiplied out side
by side and then joined, and documents follow each other with steps that forget. A document's marginals give their sum, their
largest two, and how dense they are, from which a logistic model fitted on the training documents gives the score. Stretches
of tokens with a marginal of SPAN or more are the offending spans, in characters of the text.

Bounds, all parameters of `Sizes`: the model is fitted on at most `toxic` and `clean` labelled documents, those of least hash of
the id, whole, one text of each id and one id of each text; the field on at most `stretches` stretches of tokens with a toxic
token and as many without. The scores' odds are set right for the shares of all labels. Scoring covers every row.

Null and empty texts have no tokens and get the score of a document without any. A document labelled both ways is toxic;
labels that are null or of a null id are not used. A null id counts as the empty text in checksums. Rows that repeat an id
each have a row of the result. Without training documents of both kinds every score is the share of toxic ones (0 if none).
Columns other than doc_id, text and toxic are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.documents import keyed_texts, pieces
from tidemark.llm.suffix_dedup import Rolling, _mixed
from tidemark.sources.staging import settle

#: Slots of hashed features; slot 0 means none.
SLOTS = 1 << 20
BEGINNINGS = (4, 5, 6)
ENDING = 4
#: Kinds of features a token has: its word, beginnings and ending, then the words before and after.
OWN = 1 + len(BEGINNINGS) + 1
MARKING = 1 + len(BEGINNINGS)
#: A feature marks tokens if it is LIFT times as frequent in toxic documents, beyond chance (twice the log likelihood ratio).
LEAST_DOCS = 4
LIFT = 4.0
SURENESS = 20.0
#: Tokens of a stretch the field is fitted on.
STRETCH = 32
ROUNDS = 40
RATE = 0.3
PENALTY = 1e-4
SPAN = 0.5
FOLDS = 4
HELD_OUT = 2
THRESHOLD = 0.3
#: Bytes whose features are made at a time.
PART_BYTES = 4 << 20

SCORES = "doc_id long, score double, n_tokens long, spans array<struct<start:bigint,stop:bigint>>"
MEASURES = ("one", "sum", "first", "second", "dense", "tokens")


class Sizes(NamedTuple):
    """How much the model is fitted on."""

    toxic: int = 4096
    clean: int = 12_288
    stretches: int = 8192


class Field(NamedTuple):
    """Weights of features for the toxic tag, and log weights of steps [from, to] and of the first tag."""

    weights: np.ndarray
    steps: np.ndarray
    start: np.ndarray


# --- tokens and features ------------------------------------------------------------------

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32


def tokens(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the stretches of letters (a-z and all beyond ASCII) of some bytes begin and end."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = LETTER[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def folded(raw: np.ndarray) -> np.ndarray:
    """The bytes with small letters for capitals, as far as Latin-1 has them."""
    low = FOLDED[raw]
    accented = np.zeros(len(raw), bool)
    accented[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    low[accented] += 0x20
    return low


def _slots(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (_mixed(hashes + np.uint64(kind * 0x9E3779B9)) % np.uint64(SLOTS - 1)).astype(np.int32) + 1


def own_features(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Slots of each token's own features, a row for each token."""
    rolling = Rolling(folded(raw))
    out = np.zeros((len(starts), OWN), np.int32)
    out[:, 0] = _slots(rolling(starts, stops), 0)
    for i, size in enumerate(BEGINNINGS):
        long = stops - starts > size
        out[long, 1 + i] = _slots(rolling(starts[long], starts[long] + size), 1)
    long = stops - starts > ENDING
    out[long, OWN - 1] = _slots(rolling(stops[long] - ENDING, stops[long]), 2)
    return out


def beside(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots for the word before and the word after each token; none at the edges of a document."""

    def moved(x: np.ndarray, kind: int) -> np.ndarray:
        return np.where(x > 0, (x.astype(np.int64) * (2 * kind + 1) * 0x9E3779B1 >> 7) % (SLOTS - 1) + 1, 0).astype(np.int32)

    before, after = np.zeros_like(words), np.zeros_like(words)
    if len(words):
        before[1:] = np.where(first[1:], 0, words[:-1])
        after[:-1] = np.where(first[1:], 0, words[1:])
    return moved(before, 1), moved(after, 2)


class Read(NamedTuple):
    """Tokens of texts in turn: where they begin and end in the joined bytes, and which are the first of a text."""

    raw: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    first: np.ndarray
    ends: np.ndarray


def read(texts: list[bytes]) -> Read:
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    starts, stops = tokens(raw)
    ends = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in texts]))  # tokens up to each text's end
    first = np.zeros(len(starts) + 1, bool)
    first[np.concatenate([[0], ends])] = True
    return Read(raw, starts, stops, first[:-1], ends)


def features(r: Read) -> Iterator[tuple[slice, np.ndarray]]:
    """The own features of all tokens, a bounded part of the bytes at a time."""
    at = 0
    while at < len(r.starts):
        base = r.starts[at]
        until = max(at + 1, int(np.searchsorted(r.stops, base + PART_BYTES, side="right")))
        part = slice(at, until)
        yield part, own_features(r.raw[base : r.stops[until - 1]], r.starts[part] - base, r.stops[part] - base)
        at = until


def emissions(r: Read, weights: np.ndarray) -> np.ndarray:
    """The log odds that each token's features give it."""
    odds, words = np.zeros(len(r.starts)), np.zeros(len(r.starts), np.int32)
    for part, own in features(r):
        odds[part] = weights[own].sum(axis=1)
        words[part] = own[:, 0]
    for slots in beside(words, r.first):
        odds += weights[slots]
    return odds


# --- forward-backward ----------------------------------------------------------------------


def marginals(odds: np.ndarray, first: np.ndarray, steps: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The probability that each token is toxic, given its whole chain; chains begin where `first` says."""
    n = len(odds)
    if not n:
        return np.zeros(0)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    toxic = np.full(rows * width, 0.5)
    toxic[:n] = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    begins = np.ones(rows * width, bool)
    begins[:n] = first
    toxic, begins = toxic.reshape(rows, width), begins.reshape(rows, width)
    move, new = np.exp(steps - steps.max()), np.exp(start - start.max())

    def matrix(i: int) -> np.ndarray:
        """The step into place i of each row: [row, from, to]."""
        m = np.where(begins[:, i, None, None], new[None, None, :], move[None, :, :])
        return m * np.stack([1 - toxic[:, i], toxic[:, i]], axis=1)[:, None, :]

    whole = np.broadcast_to(np.eye(2), (rows, 2, 2))
    for i in range(width):
        whole = np.matmul(whole, matrix(i))
        whole = whole / whole.sum(axis=(1, 2), keepdims=True)
    forward, backward = np.empty((rows, 2)), np.empty((rows, 2))
    state = np.full(2, 0.5)
    for row in range(rows):  # what comes into each row
        forward[row] = state
        state = state @ whole[row]
        state = state / state.sum()
    state = np.full(2, 0.5)
    for row in range(rows - 1, -1, -1):
        backward[row] = state
        state = whole[row] @ state
        state = state / state.sum()
    alpha = np.empty((width, rows, 2))
    for i in range(width):
        forward = np.einsum("rf,rft->rt", forward, matrix(i))
        forward /= forward.sum(axis=1, keepdims=True)
        alpha[i] = forward
    for i in range(width - 1, -1, -1):
        alpha[i] *= backward
        alpha[i] /= alpha[i].sum(axis=1, keepdims=True)
        backward = np.einsum("rft,rt->rf", matrix(i), backward)
        backward /= backward.sum(axis=1, keepdims=True)
    return alpha[:, :, 1].T.reshape(-1)[:n]


# --- fitting ------------------------------------------------------------------------------


def fit_field(own: np.ndarray, tags: np.ndarray, lengths: np.ndarray) -> Field:
    """Weights of greatest penalised likelihood of tagged stretches: own features [stretch, token, kind], tags [stretch, token]."""
    n, size = tags.shape
    present = np.arange(size)[None, :] < lengths[:, None]
    first = np.zeros((n, size), bool)
    first[:, 0] = True
    words = np.where(present, own[:, :, 0], 0)
    near = [x.reshape(n, size) for x in beside(words.reshape(-1), first.reshape(-1))]
    slots = np.concatenate([np.where(present[:, :, None], own, 0), np.stack(near, axis=2)], axis=2)
    used, at = np.unique(slots, return_inverse=True)  # only slots that occur have weights
    at = at.reshape(slots.shape)
    weights, steps, start = np.zeros(len(used)), np.zeros((2, 2)), np.zeros(2)
    squares = [np.full(x.shape, 1e-6) for x in (weights, steps, start)]
    step_counts = np.zeros((2, 2))
    inner = present[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            step_counts[a, b] = ((tags[:, :-1] == a) & (tags[:, 1:] == b) & inner).sum()
    start_counts = np.array([(tags[:, 0] == t).sum() for t in (0, 1)], float)
    for _ in range(ROUNDS):
        odds = np.clip(weights[at].sum(axis=2), -30, 30)
        toxic = 1 / (1 + np.exp(-odds))
        emit = np.stack([1 - toxic, toxic], axis=2)
        move, new = np.exp(steps), np.exp(start)
        alpha, beta = np.empty((size, n, 2)), np.ones((size, n, 2))
        for i in range(size):
            into = np.broadcast_to(new, (n, 2)) if i == 0 else alpha[i - 1] @ move
            alpha[i] = into * emit[:, i]
            alpha[i] /= alpha[i].sum(axis=1, keepdims=True)
        expected_steps = np.zeros((2, 2))
        for i in range(size - 1, 0, -1):
            ahead = emit[:, i] * beta[i]
            pair = alpha[i - 1][:, :, None] * move * ahead[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            expected_steps += (pair * present[:, i, None, None]).sum(axis=0)
            back = ahead @ move.T
            beta[i - 1] = np.where(present[:, i, None], back / back.sum(axis=1, keepdims=True), 1.0)
        gamma = alpha * beta
        gamma = (gamma / gamma.sum(axis=2, keepdims=True)).transpose(1, 0, 2)
        wrong = np.where(present, tags - gamma[:, :, 1], 0.0)
        slopes = [
            np.bincount(at.reshape(-1), np.repeat(wrong.reshape(-1), slots.shape[2]), minlength=len(used)) / n - PENALTY * weights,
            (step_counts - expected_steps) / n - PENALTY * steps,
            (start_counts - gamma[:, 0].sum(axis=0)) / n - PENALTY * start,
        ]
        slopes[0][used == 0] = 0
        for values, slope, square in zip((weights, steps, start), slopes, squares):
            square += slope * slope
            values += RATE * slope / np.sqrt(square)
    every = np.zeros(SLOTS, np.float32)
    every[used] = weights
    return Field(every, steps, start)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients of greatest likelihood of weighted rows, by Newton steps with a small ridge."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 1e-2 * beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(beta))
        step = np.linalg.solve(bend, slope)
        beta += step * min(1.0, 4.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return beta


# --- in Spark ------------------------------------------------------------------------------


def fold_of(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")).cast("binary")) % FOLDS


def _texts(piece: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in piece.column("text").cast(pa.binary()).to_pylist()]


def labelled_texts(docs: DataFrame, labels: DataFrame, sizes: Sizes) -> tuple[DataFrame, dict[int, int]]:
    """The documents that the model is fitted on (`toxic`, `text`), and how many labels there are of each kind."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold_of(F.col("doc_id")) != HELD_OUT))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    shares = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [rows.where(F.col("toxic") == kind).orderBy(*by_hash).limit(n) for kind, n in ((1, sizes.toxic), (0, sizes.clean))]
    chosen = settle(chosen[0].unionByName(chosen[1]), "toxicity-labels")  # of bounded size, so texts are not shuffled for it
    found = keyed_texts(docs).where("text is not null").join(chosen, "doc_id")
    one = found.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    one = one.groupBy(F.xxhash64("text").alias("of")).agg(F.max("toxic").alias("toxic"), F.min_by("text", "doc_id").alias("text"))
    return settle(one.select("toxic", "text"), "toxicity-texts"), shares


def marking_slots(rows: DataFrame) -> np.ndarray:
    """Features of words and beginnings that stand in far more toxic than clean documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            r = read(_texts(piece))
            of = np.searchsorted(r.ends, np.arange(len(r.starts)), side="right")
            seen = [np.unique(of[part, None] * SLOTS + own[:, :MARKING]) for part, own in features(r)]
            seen = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
            toxic = np.array(piece.column("toxic").to_pylist(), np.int64)[seen // SLOTS]
            slots, at = np.unique(seen % SLOTS, return_inverse=True)
            counts = [np.bincount(at, toxic == kind, minlength=len(slots)).astype(np.int64) for kind in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(slots), *map(pa.array, counts)], ["slot", "toxic", "clean"])

    sums = rows.mapInArrow(run, "slot long, toxic long, clean long").where("slot > 0").groupBy("slot")
    sums = sums.agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = F.lit(float(n.get(1, 0))), F.lit(float(n.get(0, 0)))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    mean = (a + b) / (toxic + clean)
    ratio = 2 * (a * F.log(a / (toxic * mean)) + F.when(b > 0, b * F.log(b / (clean * mean))).otherwise(0.0))
    marks = (a >= LEAST_DOCS) & (a / toxic >= LIFT * (b + 0.5) / (clean + 1)) & (ratio >= SURENESS)
    return np.sort(sums.where(F.col("a") >= LEAST_DOCS).where(marks).select("slot").toArrow()["slot"].to_numpy())


def stretches(rows: DataFrame, marks: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features, tags and lengths of stretches of tokens: `most` with a toxic token and `most` without, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            r = read(_texts(piece))
            toxic = np.array(piece.column("toxic").to_pylist(), bool)
            of = np.searchsorted(r.ends, np.arange(len(r.starts)), side="right")
            place = np.arange(len(of)) - np.concatenate([[0], r.ends])[of]
            for part, own in features(r):
                tags = (np.isin(own[:, :MARKING], marks).any(axis=1) & toxic[of[part]]).astype(np.uint8)
                cut = np.flatnonzero((place[part] % STRETCH == 0) | (np.arange(len(tags)) == 0))
                ends = np.append(cut[1:], len(tags))
                columns = [
                    pa.array([bool(tags[a:b].any()) for a, b in zip(cut, ends)]),
                    pa.array([own[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()),
                    pa.array([tags[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["toxic", "own", "tags"])

    every = rows.mapInArrow(run, "toxic boolean, own binary, tags binary")
    found = []
    for kind in (F.col("toxic"), ~F.col("toxic")):
        found += every.where(kind).orderBy(F.xxhash64("own"), "own", "tags").limit(most).select("own", "tags").collect()
    lengths = np.array([len(x["tags"]) for x in found], np.int64)
    own, tags = np.zeros((len(found), STRETCH, OWN), np.int32), np.zeros((len(found), STRETCH), np.int64)
    for i, x in enumerate(found):
        own[i, : lengths[i]] = np.frombuffer(x["own"], np.int32).reshape(-1, OWN)
        tags[i, : lengths[i]] = np.frombuffer(x["tags"], np.uint8)
    return own, tags, lengths


def measures(r: Read, odds: np.ndarray) -> np.ndarray:
    """What a document's score is made of, a row for each: from the marginals and the number of tokens."""
    counts = np.diff(r.ends, prepend=0)
    out = np.zeros((len(counts), len(MEASURES)))
    some = np.flatnonzero(counts)
    begins = (r.ends - counts)[some]
    if len(some):
        total, top = np.add.reduceat(odds, begins), np.maximum.reduceat(odds, begins)
        of = np.repeat(np.arange(len(some)), counts[some])
        rest = odds.copy()
        leading = np.flatnonzero(rest == top[of])
        rest[leading[np.unique(of[leading], return_index=True)[1]]] = 0  # the first of the largest
        out[some, 1], out[some, 2], out[some, 3] = np.log1p(total), top, np.maximum.reduceat(rest, begins)
        out[some, 4] = np.sqrt(total / counts[some])
    out[:, 0], out[:, 5] = 1, np.log1p(counts) / 10
    return out


def fit(docs: DataFrame, labels: DataFrame, sizes: Sizes = Sizes()) -> tuple[Field | None, np.ndarray]:
    """The field and the logistic coefficients; without documents of both kinds no field, and the share of toxic ones."""
    rows, shares = labelled_texts(docs, labels, sizes)
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return None, np.array([shares.get(1, 0) / max(1, sum(shares.values()))])
    field = fit_field(*stretches(rows, marking_slots(rows), sizes.stretches))
    known = rows.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            r = read(_texts(piece))
            x = measures(r, marginals(emissions(r, known.value.weights), r.first, known.value.steps, known.value.start))
            yield pa.RecordBatch.from_arrays([piece.column("toxic"), *(pa.array(c) for c in x.T)], ["toxic", *MEASURES])

    table = rows.select("toxic", "text").mapInArrow(run, "toxic int, " + ", ".join(f"{c} double" for c in MEASURES)).toArrow()
    x, y = np.column_stack([table[c].to_numpy() for c in MEASURES]), table["toxic"].to_numpy()
    order = np.lexsort((*x.T, y))
    weight = np.where(y == 1, shares[1] / n[1], shares[0] / n[0])
    return field, fit_logistic(x[order], y[order].astype(float), (weight * len(y) / weight.sum())[order])


def tag(docs: DataFrame, field: Field | None, coefficients: np.ndarray) -> DataFrame:
    """doc_id, score, number of tokens and offending spans (in characters) of every document."""
    rows = keyed_texts(docs)
    known = rows.sparkSession.sparkContext.broadcast((field, coefficients))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, coefficients = known.value
        for piece in pieces(batches):
            texts = _texts(piece)
            r = read(texts)
            counts = np.diff(r.ends, prepend=0)
            if field is None:
                scores, spans = np.full(len(texts), coefficients[0]), [[] for _ in texts]
            else:
                toxic = marginals(emissions(r, field.weights), r.first, field.steps, field.start)
                scores = 1 / (1 + np.exp(-np.clip(measures(r, toxic) @ coefficients, -30, 30)))
                scores = np.round(scores, 9)  # the last digits depend on which documents come together
                spans = offending(r, toxic, texts)
            columns = [piece.column("doc_id"), pa.array(scores), pa.array(counts.astype(np.int64)), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "n_tokens", "spans"])

    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    return rows.mapInArrow(run, SCORES)


def offending(r: Read, toxic: np.ndarray, texts: list[bytes]) -> list[list[dict]]:
    """For each text the character offsets of its stretches of tokens with a marginal of SPAN or more."""
    spans: list[list[dict]] = [[] for _ in texts]
    over = np.flatnonzero(toxic >= SPAN)
    if not len(over):
        return spans
    opens = np.ones(len(over), bool)
    opens[1:] = (np.diff(over) > 1) | r.first[over[1:]]
    firsts = over[opens]
    lasts = over[np.append(np.flatnonzero(opens)[1:] - 1, len(over) - 1)]
    characters = np.concatenate([[0], np.cumsum((r.raw & 0xC0) != 0x80)])
    begins = np.cumsum([0, *(len(x) + 1 for x in texts)])
    of = np.searchsorted(r.ends, firsts, side="right")
    shift = characters[begins[of]]
    for text, a, b in zip(of.tolist(), (characters[r.starts[firsts]] - shift).tolist(), (characters[r.stops[lasts]] - shift).tolist()):
        spans[text].append({"start": a, "stop": b})
    return spans


def score(docs: DataFrame, labels: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """doc_id, held_out, score, predicted and offending spans of every document, learning from labels that are not held out."""
    tagged = tag(docs, *fit(docs, labels, sizes))
    return tagged.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "spans",
    )
