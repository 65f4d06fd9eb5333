"""Hashes of words and word shingles of many texts at once, without an object for each word."""

from __future__ import annotations

import re

import numpy as np

from tidemark.llm.suffix_dedup import Rolling, _mixed

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CUT = re.compile(rb"[\x20\x09-\x0D]")
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


#: Bytes hashed at a time; longer texts are cut at white space.
PART_BYTES = 4 << 20


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each lower-cased word ([^\\x20\\x09-\\x0D]+) of the texts in turn, and the words before each text's end."""
    if len(texts) == 1 and len(texts[0]) > PART_BYTES:
        found, start = [], 0
        while start < len(texts[0]):
            stop = CUT.search(texts[0], min(len(texts[0]), start + PART_BYTES))
            part = texts[0][start : stop.start() if stop else len(texts[0])]
            found.append(_hashes([part])[0])
            start += max(1, len(part))
        hashes = np.concatenate(found)
        return hashes, np.array([len(hashes)])
    return _hashes(texts)


def _hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = ~SPACE[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.insert(edge, 0, 0)
    starts, stops = edge[::2], edge[1::2]  # the last byte is a space
    ends = np.cumsum(np.array([len(x) + 1 for x in texts], np.int64))
    return Rolling(raw)(starts, stops), np.searchsorted(starts, ends)


def shingle_sets(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of the texts in turn, and where each text's end.

    A text of fewer words has one shingle of all its words; one without words has none.
    """
    words, ends = word_hashes(texts)
    counts = np.diff(ends, prepend=0)
    width = np.where(counts >= size, counts - size + 1, counts > 0)
    stops = np.cumsum(width)
    value = np.zeros(int(width.sum()), np.uint64)
    new = np.ones(len(value), bool)
    with np.errstate(over="ignore"):
        total = np.zeros(max(len(words) - size + 1, 0), np.uint64)
        for i in range(size if len(total) else 0):
            total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(total)]
        total = _mixed(total)
        for i in np.flatnonzero(width).tolist():
            stop, end = stops[i], ends[i]
            own = value[stop - width[i] : stop]
            if counts[i] >= size:
                own[:] = total[end - counts[i] : end - size + 1]
                own.sort()
                new[stop - width[i] + 1 : stop] = own[1:] != own[:-1]
                continue
            short = np.uint64(counts[i])
            for w in words[end - counts[i] : end]:
                short = short * np.uint64(0xC2B2AE3D27D4EB4F) + w
            own[:] = _mixed(np.array([short], np.uint64))
    return value[new], np.concatenate([[0], np.cumsum(new)])[stops]
