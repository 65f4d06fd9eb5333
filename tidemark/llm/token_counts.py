"""Token counts with a library tokenizer, huge texts by overlapping chunks.

A huge text is encoded in chunks that overlap; every token keeps its character offsets. Two neighbouring chunks are
spliced at a boundary between matches of the pre-tokenizer that both report inside the overlap. Such a boundary is
proven stable: what the scan matches after it depends on the text after it alone, and what it matched before it had at
least one more character to see before the first chunk was cut off, and `MARGIN` characters where a special string might
have been cut. When the chunks share no such boundary, the overlap is doubled, up to the whole of the two chunks, which
are then one.

Shorter texts are cut before each space or line break that follows a character other than white space. No match of the
pre-tokenizer crosses such a place, so each distinct cutting is given to the library once and its count is used again.

Null and empty texts count 0 tokens; every row of the input has a row of the result, repeated rows too.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidemark.llm.documents import keyed_texts, pieces

#: Texts of more characters are encoded in overlapping chunks.
HUGE_CHARS = 32_768
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
#: Characters before the end of a chunk in which no boundary is trusted; more than any special string has.
MARGIN = 64
#: Distinct cuttings whose counts a worker keeps.
KEPT_CUTTINGS = 500_000
CUT = re.compile(r"(?<=\S)(?=[ \n])")


@functools.lru_cache(maxsize=2)
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def _starts(tokenizer: Tokenizer, text: str, begin: int, stop: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Of text[begin:stop]: where the pre-tokenizer's matches start in the text, the tokens before each, all tokens."""
    coded = tokenizer.encode(text[begin:stop], add_special_tokens=False)
    words, offsets = coded.word_ids, coded.offsets
    first = [i for i in range(len(words)) if i == 0 or words[i] is None or words[i] != words[i - 1]]
    return np.array([begin + offsets[i][0] for i in first], np.int64), np.array(first, np.int64), len(words)


def count_huge(
    tokenizer: Tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, margin: int = MARGIN
) -> int:
    """Tokens of a text, never holding the encoding of more than a chunk and its neighbour, unless they share no
    boundary at all."""
    total, begin = 0, 0  # tokens before `begin`, where a match is known to start
    stop = min(len(text), chunk)
    starts, before, count = _starts(tokenizer, text, begin, stop)
    while stop < len(text):
        width, splice = overlap, None
        after = min(len(text), stop + chunk)
        while splice is None and stop - width > begin:
            further, ahead, rest = _starts(tokenizer, text, stop - width, after)
            # the first start of a chunk is where it was cut, and no boundary that it has found
            both = np.intersect1d(starts[starts < stop - margin], further[1:])
            if len(both):
                splice = int(both[-1])
            else:
                width *= 2
        if splice is None:  # no common boundary: the two chunks are encoded as one
            stop = after
            starts, before, count = _starts(tokenizer, text, begin, stop)
            continue
        total += int(before[np.searchsorted(starts, splice)])
        skip = int(np.searchsorted(further, splice))
        begin, stop = splice, after
        starts, before, count = further[skip:], ahead[skip:] - ahead[skip], rest - int(ahead[skip])
    return total + count


class Counter:
    """Counts texts with one tokenizer; keeps the counts of cuttings."""

    def __init__(self, path: str, huge: int = HUGE_CHARS):
        self.tokenizer, self.huge = library(path), huge
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        cut = [CUT.split(x) if len(x) <= self.huge else [] for x in texts]
        if len(self.known) > KEPT_CUTTINGS:
            self.known = {}
        new = list({x for row in cut for x in row}.difference(self.known))
        if new:
            coded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            self.known.update(zip(new, map(len, coded), strict=True))
        known = self.known
        return [
            sum(map(known.__getitem__, row)) if len(x) <= self.huge else count_huge(self.tokenizer, x)
            for x, row in zip(texts, cut, strict=True)
        ]


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for piece in pieces(batches, limit=1 << 20):
            texts = [x or "" for x in piece.column("text").to_pylist()]
            n = np.array(count(texts), np.int64)
            size = pa.compute.fill_null(pa.compute.binary_length(piece.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), size, pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return keyed_texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
