"""Toxic spans: the field against sums over all taggings, held-out accuracy, and odd rows."""

import itertools
import zlib

import numpy as np
import pytest

from tidemark.llm import toxicity as X
from tidemark.llm.documents import load


def test_marginals_are_sums_over_all_taggings():
    random = np.random.default_rng(2)
    for _ in range(20):
        lengths = random.integers(1, 7, random.integers(1, 6))
        odds, steps, start = random.normal(0, 2, lengths.sum()), random.normal(0, 2, (2, 2)), random.normal(0, 2, 2)
        first = np.zeros(lengths.sum(), bool)
        first[np.cumsum(lengths) - lengths] = True
        want, at = [], 0
        for n in lengths:
            total = np.zeros(n)
            whole = 0.0
            for tags in itertools.product((0, 1), repeat=int(n)):
                weight = start[tags[0]] + sum(steps[a, b] for a, b in zip(tags, tags[1:])) + sum(odds[at + i] for i in range(n) if tags[i])
                whole += np.exp(weight)
                total += np.exp(weight) * np.array(tags)
            want += (total / whole).tolist()
            at += n
        assert np.allclose(X.marginals(odds, first, steps, start), want)


def test_field_learns_words_and_steps():
    random = np.random.default_rng(4)
    n, size = 400, X.STRETCH
    lengths = random.integers(3, size + 1, n)
    own = np.zeros((n, size, X.OWN), np.int32)
    own[:, :, 0] = random.integers(1, 30, (n, size))
    tags = np.zeros((n, size), np.int64)
    tags[:, 1:] = (own[:, :-1, 0] == 7) | (own[:, 1:, 0] == 3)  # after 7, or at 3
    tags[:, 0] = own[:, 0, 0] == 3
    field = X.fit_field(own, tags, lengths)
    wrong = 0
    for i in range(n):
        k = lengths[i]
        odds = field.weights[own[i, :k]].sum(axis=1)
        first = np.arange(k) == 0
        for slots in X.beside(own[i, :k, 0], first):
            odds = odds + field.weights[slots]
        wrong += ((X.marginals(odds, first, field.steps, field.start) >= 0.5) != tags[i, :k].astype(bool)).sum()
    assert wrong <= 0.005 * lengths.sum()


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in load(spark, sf_dir, "labels").collect()}
    docs = load(spark, sf_dir)
    texts = dict(docs.select("doc_id", "text").collect())
    rows = X.score(docs, load(spark, sf_dir, "labels")).collect()
    assert len(rows) == len(texts)
    seen = {True: [0, 0], False: [0, 0]}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1
        for x in r.spans:
            part = texts[r.doc_id][x.start : x.stop]
            assert part and part[0].isalpha() and part[-1].isalpha()
        if r.held_out and r.doc_id in labels:
            seen[bool(labels[r.doc_id])][r.predicted] += 1
    assert seen[True][1] >= 0.9 * sum(seen[True]) and seen[False][1] <= 0.01 * sum(seen[False])


def few(spark, n=160):
    """Toxic documents hold a mark word; every fourth of these is one that only its beginning tells."""
    random = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(n):
        words = [f"wort{'abcdefgh'[k]}" for k in random.integers(0, 8, 30)]
        if i % 3 == 0:
            words[10], words[20] = "Grauslich!", f"gräul{'opqrst'[i % 6]}x" if i % 4 == 0 else "grauslich"
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0), "x"))
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_small_and_odd_tables(spark):
    rows, labels = few(spark)
    odd = [(None, None), (None, "x"), (1000, ""), (1001, "  \n"), (1002, "123 !!"), (1003, "a" * 5000), (1004, "wortd grauslich wortc")]
    odd += [(5, "another text of five"), (3, rows[3][1]), (1005, "İ é Ø grauslich " * 200), (1006, "wort " * 40_000 + "grauslich")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string").selectExpr("*", "1 as toxic", "2 as score", "3 as own", "4 as slot")
    more = labels.union(spark.createDataFrame([(None, 1, ""), (7, None, ""), (3, 0, ""), (99_999, 1, "")], labels.schema))
    got = {}
    for r in X.score(docs.repartition(3), more).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) + len(odd)
    for i, _ in rows:
        if i not in (3, 5):
            assert got[i][0].predicted == (i % 3 == 0), i
    assert got[1004][0].predicted == 1 and [tuple(x) for x in got[1004][0].spans] == [(6, 15)]
    assert got[1005][0].spans[0].start == 6 and got[1006][0].spans[-1].start == 200_000
    assert not got[1000][0].spans and got[1000][0].predicted == 0 and got[1000][0].score == got[1002][0].score
    again = X.score(docs.repartition(2), more).collect()
    flat = [(str(r.doc_id), r.spans, round(r.score, 7)) for r in again]
    assert sorted(flat) == sorted((str(r.doc_id), r.spans, round(r.score, 7)) for x in got.values() for r in x)


@pytest.mark.parametrize("kind", ["no labels", "one kind", "no documents", "all held out"])
def test_nothing_to_learn_from(spark, kind):
    rows, labels = few(spark, 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    if kind == "no labels":
        assert {r.score for r in X.score(docs, labels.limit(0)).collect()} == {0.0}
    if kind == "one kind":
        assert {r.score for r in X.score(docs, labels.where("toxic = 1")).collect()} == {1.0}
    if kind == "no documents":
        assert X.score(docs.limit(0), labels).count() == 0
    if kind == "all held out":
        held = labels.where("crc32(cast(doc_id as string)) % 4 = 2")
        assert {r.score for r in X.score(docs, held).collect()} == {0.0}


def test_parts_of_a_long_text(monkeypatch):
    text = [("Alpha beta Ärger " * 60).encode(), b"", b"one two"]
    weights = np.random.default_rng(1).normal(size=X.SLOTS).astype(np.float32)
    whole = X.emissions(X.read(text), weights)
    monkeypatch.setattr(X, "PART_BYTES", 50)
    assert np.allclose(X.emissions(X.read(text), weights), whole)
