"""Periodic runs against a comparison of every period in plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import periodic_runs as P
from tidemark.llm.documents import load


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and (i, j + q) not in found:  # a smaller period came before
                found[i, j + q] = q
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = sorted(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
    s, length, q = best[0] if best else (None, None, None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * length // q if best else None
    return doc_id, len(runs), s, length, q, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    got = sorted(map(tuple, P.digests(docs).collect()), key=repr)
    assert got == sorted((plain(r.doc_id, r.text) for r in rows), key=repr)
    return got


def test_given_texts(spark, sf_dir):
    docs = load(spark, sf_dir).where("length(text) < 9000")
    got = check(docs)
    assert any(r[1] for r in got) and any(not r[1] for r in got)


@pytest.mark.parametrize("tile,spread", [(32_768, 1 << 20), (64, 0), (64, 1 << 20)])
def test_odd_texts(spark, documents, monkeypatch, tile, spread):
    monkeypatch.setattr(P, "TILE_WORDS", tile)
    monkeypatch.setattr(P, "SPREAD_BYTES", spread)
    random.seed(tile + spread)
    texts = [None, "", " \n", "a", "a " * 5, "a " * 6, "a b " * 4, "a b " * 3 + "a", "A a " * 9, "x" * 5000, "é é " * 7]
    texts += ["a " * 3000, "a b c " * 700 + "d " + "b c a " * 400, ("u v w x y z " * 50 + "q ") * 5]
    for _ in range(60):
        n, p = random.randint(1, 900), random.randint(1, 120)
        root = [random.choice("abcdef") for _ in range(p)]
        words = [random.choice("abcd") for _ in range(random.randint(0, 80))] + (root * (n // p + 1))[:n]
        if random.random() < 0.5:
            words[random.randrange(len(words))] = "!"
        texts.append("\n".join(words))
    docs = documents(texts)
    check(docs.union(docs.where("doc_id % 7 = 0")).union(docs.selectExpr("null", "text", "lang", "source", "n_words", "row").limit(12)))
    assert P.digests(docs.limit(0)).count() == 0


def test_runs_of_texts_as_they_are(spark, documents):
    docs = documents(["k " + "a b c " * 5, "a a"])
    assert [tuple(r) for r in P.runs(docs).collect()] == [(0, 1, 15, 3)]


def test_z_values_and_boundaries():
    random.seed(5)
    for _ in range(300):
        n = random.randint(1, 60)
        words = np.array([random.randrange(2) for _ in range(n)] * random.randint(1, 4))
        cap = random.randint(1, 40)
        upto = random.randint(1, len(words))
        want = [0] + [next((k for k in range(len(words) - i) if words[k] != words[i + k]), len(words) - i) for i in range(1, upto)]
        assert P.z_values(words, upto, cap).tolist() == [min(x, cap) for x in want]


def test_thue_morse_hashes_mislead_no_one():
    words = np.array([bin(i).count("1") % 2 for i in range(1 << 13)], np.int64)
    for octave in (32, 128, 512):
        assert list(P.solve(words, octave)) == []  # it has no fourth powers
