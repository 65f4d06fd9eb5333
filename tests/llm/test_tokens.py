"""Encoders and counters against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, documents, token_counts, token_files

ODD = [
    None, "", " ", "a", "\x1c\x1d x\x1f", "  \n\n x  ", "é" * 100, "a" * 3000, "x\x85y z\xa0 q", "<|endoftext|> hi", "日本語 12 ",
    "it's don't 'S", " " * 500 + "x", "=-" * 900, "A,B.c?!d<|startoftext|>", "same text", "same text", "́x İ ﬁ",
]
RANKS, MULTI = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_multi_50k.tiktoken")
COUNTED, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")


def reference(path):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.coder(path, P.PATTERN).ranks, special_tokens={})


@pytest.mark.parametrize("path", [RANKS, MULTI])
@settings(max_examples=40, deadline=None)
@given(texts=st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=4))
def test_bpe_equals_the_library(path, texts):
    coder, want = byte_bpe.coder(path, P.PATTERN), reference(path)
    ids, ends = coder.encode(texts)
    raw, cuts = coder.decode(ids, ends)
    assert [x.tolist() for x in np.split(ids, ends[:-1])][: len(texts)] == [want.encode_ordinary(x) for x in texts]
    assert raw == "".join(texts).encode() and len(cuts) == len(texts)


def test_bpe_documents(documents):
    docs = documents(ODD)
    got = {r.doc_id: tuple(r)[1:] for r in byte_bpe.digests(docs, RANKS, P.PATTERN).collect()}
    want = reference(RANKS)
    for i, text in enumerate(ODD):
        ids = np.array(want.encode_ordinary(text or ""), "<u4")
        assert got[i] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    back = {r.doc_id: r for r in byte_bpe.encode_documents(docs, RANKS, P.PATTERN).collect()}
    assert all(bytes(back[i].decoded) == (x or "").encode() for i, x in enumerate(ODD))
    assert byte_bpe.digests(docs.limit(0), RANKS, P.PATTERN).count() == 0


@pytest.mark.parametrize("chunk, overlap", [(40, 20), (100, 30), (400, 200)])
def test_spliced_counts(chunk, overlap):
    tokenizer = token_counts.library(COUNTED)
    random.seed(chunk)
    parts = ["a", "bc ", " ", "\n", "\t", "\x1c", "<|endoftext|>", "<|endof", "|>", "'s", "é", "7"]
    for _ in range(300):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 150)))
        want = len(tokenizer.encode(text, add_special_tokens=False))
        assert token_counts.count_huge(tokenizer, text, chunk, overlap, margin=16) == want


def test_counted_documents(documents):
    texts = [*ODD, "word " * 9000, "x" * 40_000, "<|endoftext|>" * 4000]
    got = {r.doc_id: tuple(r)[1:] for r in token_counts.count_tokens(documents(texts), COUNTED).collect()}
    tokenizer = Tokenizer.from_file(COUNTED)
    for i, text in enumerate(texts):
        n = len(tokenizer.encode(text or "", add_special_tokens=False))
        assert got[i] == (len((text or "").encode()), n, n > 512)


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 5000))
    hashed = token_files.PerfectHash.of(keys)
    assert hashed.size == len(keys) and sorted(hashed(keys)) == list(range(len(keys)))
    index = token_files.ShardIndex(token_files.pack_index(np.repeat(keys, 2), np.full(2 * len(keys), 3), 0))
    first, count = index.find(keys)
    assert (first == 2 * np.arange(len(keys))).all() and (count == 2).all()
    assert index.find(keys + 1)[1].sum() <= 2 * np.isin(keys + 1, keys).sum()


def test_stored_documents(spark, documents):
    texts = [*ODD, *(f"text {i} of, more." for i in range(60))]
    docs = documents(texts).select("doc_id", "text", "n_words")
    rows = [*(tuple(r) for r in docs.collect()), (None, "no key", 0), (None, None, 0), (5, "again", 0), (5, "again", 0)]
    docs = spark.createDataFrame(rows, docs.schema).repartition(3)
    tokenizer = Tokenizer.from_file(WORDS)

    def row(key, text):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        return key, len(ids), zlib.crc32(ids), zlib.crc32(ids.astype("<u2"))  # rows of one key are in the order of the last

    want = sorted((row(*r[:2]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[3]))
    folder, bounds, shards = token_files.write(docs, WORDS, shard_rows=16)
    assert len(bounds) > 2
    got = token_files.read(docs.select("doc_id"), folder, bounds, shards).collect()
    got = sorted((tuple(r) for r in got), key=lambda r: r[1])
    assert [(r[0], *r[2:]) for r in got] == [w[:3] for w in want]
    assert [r[1] for r in got] == [sum(w[1] for w in want[:i]) for i in range(len(want))]
    unknown = spark.createDataFrame([(999_999,), (-7,)], "doc_id long")
    assert token_files.read(unknown, folder, bounds, shards).count() == 0
    assert token_files.store_and_read(docs.limit(0), WORDS).count() == 0


def test_letters_are_encoded_once_whatever_follows(monkeypatch):
    coder, plain = token_files.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    texts = ["Éçanè. éçanè, éçanè", "straße! STRAßE ×é ÷ é× üb3r é's É'S", "e\u0301. é\u0301, ÿ\u0308 İ. ſ? ﬁ! ª. µ, ñañ\u00adñ", ""]
    given = []

    class Counting:
        def encode_batch_fast(self, lines, **how):
            given.extend(x for line in lines for x in line.split(" "))
            return plain.encode_batch_fast(lines, **how)

    monkeypatch.setattr(coder, "tokenizer", Counting())
    for _ in range(2):
        ids, ends = coder(texts, 1)
        got = [x.tolist() for x in np.split(ids, ends[:-1])]
        assert got == [[*plain.encode(x, add_special_tokens=False).ids, 1] for x in texts]
    assert sum("çanè" in x for x in given) == 1 and len(given) == len(set(given))


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("aZ éÉßÿ×.,'s3\n\t\u0301\u0130\u00a0"), max_size=30), max_size=5))
def test_words_equal_the_library(texts):
    coder, plain = token_files.word_encoder(WORDS), Tokenizer.from_file(WORDS)
    ids, ends = coder(texts, 1)
    assert [x.tolist() for x in np.split(ids, ends[:-1])][: len(texts)] == [[*plain.encode(x, add_special_tokens=False).ids, 1] for x in texts]


def test_an_idle_worker_keeps_little(monkeypatch):
    coder = byte_bpe.coder(RANKS, P.PATTERN)
    assert byte_bpe.coder(RANKS, P.PATTERN) is coder
    assert documents.kept("another operator's", list) == [] and byte_bpe.coder(RANKS, P.PATTERN) is not coder
    documents.release()
    given, out = [], []
    monkeypatch.setattr(documents, "give_back", lambda: given.append(len(out)))
    out.extend(documents.lean(lambda batches: (x + 1 for x in batches))(iter([1, 2])))
    assert out == [2, 3] and len(given) == 1
    monkeypatch.undo()
    documents.give_back()
