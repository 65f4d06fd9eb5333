"""Forest search and language-model scores."""

import collections
import math
import re
import tracemalloc
import zlib

import numpy as np

from tidemark.llm import ann_forest, lm_scoring, shingles
from tidemark.llm.documents import load


def plain_nearest(ids, vectors, k):
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        score = (vectors * vectors[q]).sum(axis=1)
        score[q] = -np.inf
        order = np.lexsort((ids, -score))[: min(k, len(ids) - 1)]
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def test_recall_and_scores(spark, sf_dir):
    table = load(spark, sf_dir, "embeddings")
    rows = ann_forest.search(table).orderBy("query_id", "rank").collect()
    frame = table.toPandas()
    ids, vectors = frame.vec_id.to_numpy(), np.array(frame.embedding.tolist(), np.float64)
    want = plain_nearest(ids, vectors, 20)
    got = collections.defaultdict(list)
    place = {v: i for i, v in enumerate(ids)}
    for r in rows:
        assert r.score == (vectors[place[r.vec_id]] * vectors[place[r.query_id]]).sum() and r.vec_id != r.query_id
        got[r.query_id].append(r.vec_id)
        assert r.rank == len(got[r.query_id])
    assert got.keys() == want.keys()
    assert sum(len({v for v, _ in want[q]} & set(got[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_whole_forest_is_exact(spark):
    random = np.random.default_rng(3)
    base = random.integers(-2, 3, (300, 6)).astype(float)  # many ties, other lengths than 1
    base[::7] = base[0]
    bad = [(900, None), (920, [0.0] * 6), (940, [1.0] * 5 + [None]), (960, [math.nan] * 6), (980, [math.inf] + [1.0] * 5), (901, [1.0])]
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + bad + [(None, [1.0] * 6), (40, base[40].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as rank", "2 as score", "3 as id")
    got = collections.defaultdict(list)
    for r in ann_forest.search(table, share=16.0, block_rows=32).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    kept = [i for i, v in enumerate(base) if v.any()]
    assert dict(got) == plain_nearest(np.array(kept), base[kept], 20)
    assert ann_forest.search(table.limit(0)).count() == 0
    few = ann_forest.search(table.where("vec_id in (0, 1, 2)")).collect()
    assert len(few) == 2


def test_base_scores(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(lm_scoring, "KNOWN_WORDS", 300)
    docs = load(spark, sf_dir)
    extra = spark.createDataFrame([(None, None), (10_000, ""), (10_001, "New wordsonly"), (10_001, "New wordsonly")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(extra)
    texts = [tuple(r) for r in docs.collect()]
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    split = {(i, t): [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(lower)), None] for i, t in texts}
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    counts = collections.Counter(w for i, t in texts if not held(i) for w in split[i, t])
    total, below = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    scored = lm_scoring.score(docs).collect()
    assert len(scored) == len(texts)
    by_id = dict(texts)
    for r in scored:
        words = split[r.doc_id, by_id[r.doc_id]]
        base = sum(math.log10((counts[w] + 0.1) / below) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(words), sum(counts[w] > 0 for w in words), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0
    # held-out texts are told better than by their bytes' frequencies
    mixed = sum(r.score for r in scored if r.held_out)
    held_bytes = collections.Counter(b for i, t in texts if held(i) for b in (t or "").encode())
    order0 = sum(n * math.log10(n / sum(held_bytes.values())) for n in held_bytes.values())
    assert mixed > 0.7 * order0


def plain_mixer(mixer, texts):
    """The scores, bit by bit."""
    code = mixer.code
    symbol, ends, contexts = lm_scoring.symbols(texts)
    out, begin = [], 0
    for end in ends:
        total = 0.0
        for at in range(begin, end):
            if (at - begin) % lm_scoring.SEGMENT == 0:
                weights, refined = np.ones(3), mixer.refined.copy()
            s = symbol[at]
            for e in range(code.start[s], code.start[s] + code.size[s]):
                x = np.array([g[t[c[at] ^ code.node[e]]] for g, t, c in zip(mixer.gated, mixer.tables, contexts)])
                dot = np.clip((weights * x).sum(), -7.9, 7.9)
                cell, y = int(np.floor(2 * dot)) + 16, float(code.bit[e])
                p = 1 / (1 + np.exp(-dot))
                both = (p + refined[cell]) / 2
                total += np.log10(both if y else 1 - both)
                refined[cell] += lm_scoring.REFINE * (y - refined[cell])
                weights += lm_scoring.RATE * (y - p) * x
        out.append(total)
        begin = end
    return out


def random_mixer(seed):
    random = np.random.default_rng(seed)
    code = lm_scoring.Code(random.integers(0, 50, (256, 257)) * (random.random((256, 1)) > 0.3))
    return lm_scoring.Mixer(code, [random.integers(0, 256, 1 << b).astype(np.uint8) for b in lm_scoring.TABLE_BITS])


def test_score_is_that_of_a_plain_mixer():
    random = np.random.default_rng(6)
    mixer = random_mixer(6)
    texts = [b"", b"a", bytes(random.integers(97, 110, 700).astype(np.uint8)), b"two words, \xc3\xa9 " * 80]
    assert np.allclose(mixer(texts), plain_mixer(mixer, texts), rtol=1e-3)


def test_texts_up_to_one_byte_are_a_probability():
    scores = random_mixer(5)([b"", *(bytes([b]) for b in range(256))])
    assert 0 < (10**scores).sum() < 1


def test_codes_are_complete():
    code = random_mixer(7).code
    for before in range(256):  # Kraft's sum is 1
        assert np.isclose((0.5 ** code.size[before * 257 : before * 257 + 257].astype(float)).sum(), 1.0)


def test_lookup():
    random = np.random.default_rng(8)
    hashes = np.unique(random.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    wanted = np.concatenate([hashes[::3], hashes[:50] + np.uint64(1)])
    found = lm_scoring.Lookup(hashes)(wanted)
    assert (hashes[found[found >= 0]] == wanted[found >= 0]).all() and (found >= 0).sum() == len(hashes[::3])
    assert (lm_scoring.Lookup(hashes[:0])(wanted) == -1).all()


def test_long_texts_are_scored_in_parts(monkeypatch):
    mixer = random_mixer(9)
    random = np.random.default_rng(9)
    text = bytes(random.choice(np.frombuffer(b"abcde fgh\n", np.uint8), 5000))
    whole = mixer([text])
    for size in (1024, 2500):
        monkeypatch.setattr(lm_scoring, "PIECE", size)
        assert np.allclose(mixer([text]), whole, rtol=1e-6)
    exact = text[: 2 * lm_scoring.SEGMENT]
    monkeypatch.setattr(lm_scoring, "PIECE", 1 << 20)
    whole = mixer([exact])
    monkeypatch.setattr(lm_scoring, "PIECE", lm_scoring.SEGMENT)
    assert np.allclose(mixer([exact]), whole, rtol=1e-6)


def test_words_of_long_texts(monkeypatch):
    text = b" some WORDS\n" * 50 + b"x" * 300 + b" end"
    whole = shingles.word_hashes([text])
    monkeypatch.setattr(shingles, "PART_BYTES", 64)
    cut = shingles.word_hashes([text])
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_what_is_held_follows_the_contexts(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 1 << 14)
    random = np.random.default_rng(10)
    letters = lambda n: bytes(random.integers(97, 123, n).astype(np.uint8)).decode()  # noqa: E731  # five letters hardly come twice
    texts = [letters(3000) for _ in range(400)] + ["", None, letters(20_000) + " é" * 3000]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string").repartition(3)
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    raw = [(x or "").encode() for x in texts]
    trained = [x for i, x in enumerate(raw) if not held(i)]
    symbol, _, contexts = lm_scoring.symbols(trained, bits=(64, 64, 64))
    code = lm_scoring.Code(np.bincount(symbol, minlength=256 * 257).reshape(256, 257))
    seen = [collections.defaultdict(lambda: [0, 0]) for _ in contexts]  # by whole hashes: no context shares counts
    size, node, bit = lm_scoring._bits(code, symbol)
    for k, context in enumerate(contexts):
        for c, n, b in zip(np.repeat(context, size).tolist(), node.tolist(), bit.tolist()):
            seen[k][c, n][b] += 1
    some = [i for i in range(len(texts)) if held(i)][:3] + [0, 1, 400, 401, 402]
    scores = {}
    for piece in (1 << 20, 8192):  # the long text whole, and in parts
        monkeypatch.setattr(lm_scoring, "PIECE", piece)
        rows = lm_scoring.score(docs).collect()
        assert len(rows) == len(texts)
        scores[piece] = {r.doc_id: r.score for r in rows}
    assert all(math.isclose(scores[8192][i], x, rel_tol=1e-6) for i, x in scores[1 << 20].items())
    for i in some:
        symbol, ends, contexts = lm_scoring.symbols([raw[i]], bits=(64, 64, 64))
        size, node, bit = lm_scoring._bits(code, symbol)
        exact = []
        for k, context in enumerate(contexts):
            zero, one = np.array([seen[k].get((c, n), (0, 0)) for c, n in zip(np.repeat(context, size).tolist(), node.tolist())]).T
            odds = np.clip(np.rint((np.log((one + 0.4) / (zero + 0.4)) + 8) * 4), 0, 63).astype(int)
            exact.append(odds | np.searchsorted([2, 8, 64], zero + one, side="right") << 6)
        mixer, total, e = lm_scoring.Mixer(code), 0.0, 0
        for at, n in enumerate(size):
            if at == 0:
                weights, refined = np.ones((16, 3)), mixer.refined.copy()
            for e in range(e, e + n):
                x = np.array([g[v[e]] for g, v in zip(mixer.gated, exact)])
                gate = (exact[1][e] >> 6) + 4 * (exact[2][e] >> 6)
                dot = np.clip((weights[gate] * x).sum(), -7.9, 7.9)
                cell, y, p = int(np.floor(2 * dot)) + 16, float(bit[e]), 1 / (1 + np.exp(-dot))
                both = (p + refined[cell]) / 2
                total += np.log10(both if y else 1 - both)
                refined[cell] += lm_scoring.REFINE * (y - refined[cell])
                weights[gate] += lm_scoring.RATE * (y - p) * x
            e += 1
        assert math.isclose(scores[1 << 20][i], total, rel_tol=1e-3)


def test_trained_weight_sets_are_kept_along_a_text(monkeypatch):
    random = np.random.default_rng(12)
    plain = random_mixer(12)
    mixer = lm_scoring.Mixer(plain.code, plain.tables, sets=lm_scoring.GATED_SETS)
    texts = [b"", bytes(random.choice(np.frombuffer(b"abcde fgh\n", np.uint8), 3000)), b"two words " * 90]
    want = []
    for text in texts:
        symbol, _, contexts = lm_scoring.symbols([text])
        size, node, bit = lm_scoring._bits(mixer.code, symbol)
        values = [t[np.repeat(c, size) ^ node].astype(int) for t, c in zip(mixer.tables, contexts)]
        weights, refined, total = np.ones((16, 3)), mixer.refined.copy(), 0.0
        for e, y in enumerate(bit.astype(float)):
            gate = (values[1][e] >> 6) + 4 * (values[2][e] >> 6)
            x = np.array([g[v[e]] for g, v in zip(mixer.gated, values)])
            dot = np.clip((weights[gate] * x).sum(), -7.9, 7.9)
            cell, p = int(np.floor(2 * dot)) + 16, 1 / (1 + np.exp(-dot))
            total += np.log10((p + refined[cell]) / 2 if y else 1 - (p + refined[cell]) / 2)
            refined[cell] += lm_scoring.REFINE * (y - refined[cell])
            weights[gate] += lm_scoring.RATE * (y - p) * x
        want.append(total)
    for size in (1 << 20, 700):
        monkeypatch.setattr(lm_scoring, "PIECE", size)
        assert np.allclose(mixer(texts), want, rtol=1e-3)


def test_scores_without_training_rows_or_rows(spark):
    none = spark.createDataFrame([(6, "held out"), (6, None)], "doc_id long, text string")  # crc32("6") % 10 is 0
    for rows in (none, none.withColumn("doc_id", none.doc_id * 0 + 6)):
        got = lm_scoring.score(rows).collect()
        assert len(got) == 2 and all(r.held_out and r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert lm_scoring.score(none.limit(0)).count() == 0


def test_ranks_with_values_alike_in_their_first_bits():
    random = np.random.default_rng(14)
    for bits, values in (
        (64, random.integers(0, 50, 5000, np.uint64) * np.uint64(3)),  # differ only in the last bits
        (55, random.integers(0, 1 << 55, 5000, np.uint64)),
        (40, np.zeros(1, np.uint64)),
    ):
        assert (lm_scoring._ranks(values, bits) == np.unique(values, return_inverse=True)[1]).all()


def peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_ranks_in_bounded_memory(monkeypatch):
    values = np.random.default_rng(17).integers(0, 1 << 20, 1 << 20, np.uint64)
    monkeypatch.setattr(lm_scoring, "PIECE", 1 << 14)
    assert peak(lambda: lm_scoring._ranks(values, 38)) < 2.2 * values.nbytes  # three times before
    assert (lm_scoring._ranks(values, 38) == np.unique(values, return_inverse=True)[1]).all()


def test_words_of_a_piece_in_bounded_memory(monkeypatch):
    monkeypatch.setattr(lm_scoring, "PIECE", 1 << 16)
    texts = [b"", b"some words of a text " * 400, b" ", b"x"] * 400
    lm_scoring._words(texts[:100])  # fills what is kept between calls
    assert peak(lambda: lm_scoring._words(texts)) < 12 * sum(map(len, texts))  # over 40 times when hashed at once
    hashes, ends = shingles.word_hashes(texts)
    found, n = lm_scoring._words(texts)
    assert (found == hashes).all() and (n == np.diff(ends, prepend=0)).all()
    assert len(lm_scoring._words([b""])[0]) == 0


def test_a_shard_lets_go_of_what_it_has_read():
    random = np.random.default_rng(18)
    texts = [bytes(random.choice(np.frombuffer(b"abcde fgh\n", np.uint8), n)) for n in (4000, 900, 0)]
    parts = [part for group in lm_scoring.groups_of(texts) for part in group]
    rows = [dict(zip(lm_scoring.ASKED, x)) for x in lm_scoring._asked(np.array([True, False, True]), 4, parts)]
    code = lm_scoring.Code(random.integers(0, 50, (256, 257)))
    answers = [*lm_scoring._answers(code, [some := dict(rows[0])])]
    assert len(answers) == 1 and not set(some) & set(lm_scoring.ASKED[1:])


def test_counts_of_training_texts_alone():
    random = np.random.default_rng(19)
    texts = [bytes(random.choice(np.frombuffer(b"ab ", np.uint8), n)) for n in (3000, 2000, 700, 0)]
    training = np.array([True, False, True, True])
    [parts] = lm_scoring.groups_of(texts)
    _, _, contexts = lm_scoring._told(parts[0], 4)
    symbol = lm_scoring._told(parts[0], 4)[0] % 257
    of = np.repeat(training, [len(x) + 1 for x in texts])
    for k, context in enumerate(contexts):
        seen = collections.Counter(zip(context[of].tolist(), symbol[of].tolist()))
        asked = sorted(set(zip(context.tolist(), symbol.tolist())))
        counts = []
        for row in lm_scoring._asked(training, 4, parts):
            if row[0] >> 4 == k:
                small = lm_scoring._unpack(row[5], np.uint8).astype(int)
                small[small == 255] = lm_scoring._unpack(row[6], np.int32)
                counts += small.tolist()
        assert counts == [seen[x] for x in asked]


def test_odds_seen_from_a_bit_and_back():
    odds = np.arange(256, dtype=np.uint8)
    for bit in (np.zeros(256, np.uint8), np.ones(256, np.uint8)):
        there = lm_scoring._mirrored(odds, bit)
        assert (lm_scoring._mirrored(there, bit) == odds).all() and (there >> 6 == odds >> 6).all()


def test_a_group_asks_for_a_context_and_symbol_once():
    random = np.random.default_rng(15)
    texts = [bytes(random.choice(np.frombuffer(b"abcde fgh\n", np.uint8), n)) for n in (9000, 4000, 4000, 1, 0)]
    sizes = []
    for copies in (1, 8):
        parts = [part for group in lm_scoring.groups_of(texts * copies) for part in group]
        rows = [*lm_scoring._asked(np.ones(len(texts) * copies, bool), 4, parts)]
        assert len(rows) == len({row[0] for row in rows}) <= len(lm_scoring.GATES) << 4  # one for each predictor and shard
        sizes.append([sum(len(lm_scoring._unpack(row[4], np.uint16)) for row in rows), sum(lm_scoring._unpack(row[5], np.uint8).sum() > 0 for row in rows)])
    assert sizes[0] == sizes[1]


def test_few_texts_step_as_many_do(monkeypatch):
    mixer = random_mixer(16)
    texts = [b"some words of a text " * n for n in range(1, 30)]
    walked = mixer(texts)
    monkeypatch.setattr(lm_scoring, "FEW", 0)
    assert np.allclose(mixer(texts), walked, rtol=1e-4)
