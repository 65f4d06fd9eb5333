"""Near-duplicate join and suffix-array dedup against brute force."""

import collections
import hashlib
import random
import re

import pytest

from tidemark.llm import ngram_join, suffix_dedup

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def plain_components(ids, texts):
    sets = []
    for text in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(sets)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return {ids[i]: (len(sets[i]), least[find(i)]) for i in range(len(sets))}


def near_copies(seed, n=120):
    random.seed(seed)
    letters = [chr(97 + i) for i in range(26)]
    base = [[random.choice(letters) for _ in range(random.choice([6, 20, 40, 80, 160]))] for _ in range(4)]
    texts = []
    for _ in range(n):
        words = list(random.choice(base))
        for _ in range(random.choice([0, 1, 1, 2, 3, 6])):
            words[random.randrange(len(words))] = random.choice([*letters, "Q"])
        if random.random() < 0.2:
            words = words[: random.randint(1, len(words))]
        if random.random() < 0.1:
            base.append(words)
        texts.append(" ".join(words).upper() if random.random() < 0.1 else " ".join(words))
    return [*texts, None, "", " \n", "a b", "A B", "a", *random.sample(texts, 10)]


@pytest.mark.parametrize("settings", [(32, 256, 2048, 4), (3, 4, 20, 1), (3, 10, 60, 3)])
def test_near_duplicates(documents, monkeypatch, settings):
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", 2048 if settings[0] == 32 else 8)
    for name, value in zip(("FREQUENT", "MOST_MEMBERS", "PAIRED_SIZE", "REPORTED"), settings):
        monkeypatch.setattr(ngram_join, name, value)
    texts = near_copies(sum(settings))
    docs = documents(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == plain_components(range(len(texts)), texts)


def test_near_duplicates_of_few(documents):
    docs = documents(["a b c d e f", None])
    assert sorted(tuple(r)[:3] for r in ngram_join.near_duplicates(docs).collect()) == [(0, 2, 0), (1, 0, 1)]
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0
    again = docs.where("text is not null").union(docs)
    assert sorted(tuple(r)[:3] for r in ngram_join.near_duplicates(again).collect()) == [(0, 2, 0), (0, 2, 0), (1, 0, 1)]


def test_large_group_of_near_copies_is_connected_by_a_comparison_each(documents, monkeypatch):
    random.seed(11)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(400):
        words = list(base)
        words[random.randrange(200)] = f"x{i}"
        texts.append(" ".join(words))
    settled, settle = collections.Counter(), ngram_join.settle

    def counting(rows, name):
        done = settle(rows, name)
        settled[name] += done.count()
        return done

    monkeypatch.setattr(ngram_join, "settle", counting)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(documents(texts)).collect()}
    assert got == dict.fromkeys(range(400), 0)
    assert settled["join-likeliest"] < 400 and settled["join-likeliest"] + settled["join-stars"] < 600


@pytest.mark.parametrize("pairs_a_row, block, solved", [(0, 8, 1), (32, 8, 1024), (2, 2048, 8)])
def test_near_duplicates_in_blocks(documents, monkeypatch, pairs_a_row, block, solved):
    for name, value in {"PAIRS_A_ROW": pairs_a_row, "BLOCK_NODES": block, "SOLVED_NODES": solved, "BEST": 1, "RANGE_BITS": 0}.items():
        monkeypatch.setattr(ngram_join, name, value)
    texts = near_copies(17 + block + solved)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents(texts)).collect()}
    assert got == plain_components(range(len(texts)), texts)


def test_sets_that_share_much_but_do_not_link_make_few_pairs(documents, monkeypatch):
    random.seed(5)
    phrases = [" ".join(f"w{i}_{k}" for k in range(12)) for i in range(100)]
    texts = [" ".join(random.sample(phrases, 30)) for _ in range(100)]
    settled, settle = collections.Counter(), ngram_join.settle

    def counting(rows, name):
        done = settle(rows, name)
        settled[name] += done.count()
        return done

    monkeypatch.setattr(ngram_join, "settle", counting)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(documents(texts)).collect()}
    assert got == {k: c for k, (_, c) in plain_components(range(100), texts).items()}
    assert settled["join-stars"] + settled["join-best"] + settled["join-all"] < 100


def test_least_hashes():
    import numpy as np

    values = np.sort(np.random.default_rng(3).integers(0, 2**64, 50, dtype=np.uint64))
    want = sorted({int(min(values[values >> np.uint64(61) == i])) for i in np.unique(values >> np.uint64(61))})
    assert set(want) <= set(ngram_join.least_hashes(values).tolist()) <= {*want, int(values[-1])}
    one = np.array([5 << 61], np.uint64)
    assert ngram_join.least_hashes(one).tolist() == [5 << 61] and not len(ngram_join.least_hashes(one[:0]))


def test_sketches_never_rule_out_a_link():
    import numpy as np

    random.seed(4)
    for _ in range(300):
        n = random.choice([1, 3, 30, 400, 2000])
        a = {random.getrandbits(64) for _ in range(n)}
        b = {x if random.random() > 0.15 else random.getrandbits(64) for x in a if random.random() > 0.1}
        if b and 100 * len(a & b) >= 75 * len(a | b):
            drawn = ngram_join.Sketches([ngram_join.sketch(np.array(sorted(s), np.uint64)) for s in (a, b)])
            assert drawn.most(0, np.array([1]))[0] >= len(a & b) and drawn.may_link(0, np.array([1]))[0]


def plain_repeats(texts, length):
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        kept = bytes(b for b, m in zip(t, mask) if not m)
        out.append((len(t), sum(mask), len(re.findall(b"\1+", mask)), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [2048, 20, 3])
def test_repeats(documents, hot):
    random.seed(hot)
    base = ["".join(random.choice("abcdé \n") for _ in range(random.randint(0, 300))) for _ in range(6)]
    texts = []
    for _ in range(60):
        cut = (random.choice(base)[random.randint(0, 50) : random.randint(50, 300)] for _ in range(random.randint(0, 6)))
        texts.append("".join(x + random.choice(["", "x", "a" * random.randint(0, 120)]) for x in cut))
    texts += [*random.sample(texts, 5), None, "", "a" * 500, "ab" * 300, "\0" * 200, "\0" * 150]
    rows = suffix_dedup.digests(documents(texts), "doc_id", 80, 16, hot).collect()
    want = plain_repeats([(t or "").encode() for t in texts], 80)
    assert {r.doc_id: tuple(r)[1:5] for r in rows} == dict(enumerate(want))
    for r in rows:  # the kept text, but where a character was cut in part
        assert "\ufffd" in r.text or hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256


def test_repeats_of_few(documents):
    docs = documents(["x" * 399, "short", None])
    assert [r.n_removed for r in suffix_dedup.digests(docs).collect()] == [0, 0, 0]
    assert suffix_dedup.digests(docs.limit(0)).count() == 0


def test_long_texts_are_hashed_in_parts(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 1000)
    random.seed(7)
    long = "".join(random.choice("abcdef") for _ in range(6000))
    texts = [long, "zz" + long[1500:3300], long[5500:] + "y"]
    found = suffix_dedup.find_anchors(suffix_dedup._keyed(documents(texts), ["doc_id"], "text"), 400, 64).collect()
    assert len({(bytes(r.k), r.pos) for r in found}) == len(found)
    rows = suffix_dedup.digests(documents(texts)).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in rows} == dict(enumerate(plain_repeats([t.encode() for t in texts], 400)))


def test_intervals_of_the_common_prefix_tree():
    import numpy as np

    words = sorted(["banana"[i:] for i in range(6)])
    common = [-1] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(words, words[1:])]
    assert sorted(suffix_dedup.intervals(np.array(common))) == [(0, 2, 1), (1, 2, 3), (4, 5, 2)]
