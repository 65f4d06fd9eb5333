"""Shards, quality rules and mixing against plain Python."""

import collections
import math
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from compare import connect, differences
from tidemark.llm import mixing, oracles, quality, sharding
from tidemark.llm.documents import load

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@settings(max_examples=50, deadline=None)
@given(sizes=st.lists(st.integers(0, 1000), min_size=1, max_size=60), bins=st.integers(1, 6))
def test_differencing_deals_every_group_once(sizes, bins):
    sizes = sorted(sizes, reverse=True)
    moves = sharding.difference([[s, *[0] * (bins - 1)] for s in sizes])
    assert all(sorted(m) == list(range(bins)) for m in moves)
    total = [0] * bins
    for s, m in zip(sizes, moves):
        total[m[0]] += s
    assert sum(total) == sum(sizes) and max(total) - min(total) <= max(sizes)


def test_shards(documents):
    random.seed(2)
    texts = ["x" * random.randint(0, 400) + str(i % 90) for i in range(300)] + [None, None, "", ""]
    docs = documents(texts)
    rows = sharding.by_bytes(docs, shards=5).collect()
    where = collections.defaultdict(set)
    total, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        text = texts[r.doc_id]
        assert r.size == len((text or "").encode()) + 8 and (r.text_crc32 is None) == (text is None)
        where[text].add(r.shard)
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(rows) == len(texts) and all(len(x) == 1 for x in where.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(total.values()) - min(total.values()) <= 0.02 * sum(total.values())
    # the same groups in several chunks, combined in two levels
    groups = docs.selectExpr("cast(coalesce(text, '-') as binary) g", "length(text) weight").dropDuplicates(["g"]).fillna(8)
    dealt = sharding.deal_groups(groups, 3, chunk_groups=16, fan_in=4).collect()
    assert len(dealt) == groups.count() and {r.shard for r in dealt} == {0, 1, 2}
    weight = {bytes(r.g): r.weight for r in groups.collect()}
    sums = [sum(weight[bytes(r.g)] for r in dealt if r.shard == s) for s in range(3)]
    assert max(sums) - min(sums) <= 0.05 * sum(sums)
    assert sharding.by_bytes(docs.limit(0)).count() == 0


def plain_measures(text):
    words = WORD.findall(text.encode())
    seen = collections.Counter(zip(words, words[1:], words[2:]))
    again = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x.encode())]
    return len(words), sum(len(w.decode()) for w in words), sum(c in quality.SYMBOLS for c in text), len(lines) - len(set(lines)), len(again)


@settings(max_examples=200, deadline=None)
@given(text=st.text(st.sampled_from("ab é\n\t\x0b\x1c#| "), max_size=40))
def test_measures(text):
    assert quality.measures(text) == plain_measures(text)


def plain_kneser_ney(texts):
    """Probabilities of the last class after any others, by dictionaries."""
    grams = {n: collections.Counter() for n in range(1, quality.ORDER + 1)}
    for text in texts:
        for code in quality.grams([text])[0].tolist():
            grams[quality.ORDER][code] += 1
    for n in range(quality.ORDER - 1, 0, -1):
        grams[n] = collections.Counter(code % quality.CLASSES**n for code in grams[n + 1])

    def probability(code, n):
        if n == 0:
            return 1 / quality.CLASSES
        of = [sum(c == k for c in grams[n].values()) for k in (1, 2, 3, 4)]
        y = of[0] / (of[0] + 2 * of[1]) if of[0] else 0.5
        cut = [min(0.95 * k, max(0.05, k - (k + 1) * y * of[k] / of[k - 1])) if of[k - 1] else 0.5 for k in (1, 2, 3)]
        after = {c: m for c, m in grams[n].items() if c // quality.CLASSES == code // quality.CLASSES}
        lower = probability(code % quality.CLASSES ** (n - 1), n - 1)
        if not after:
            return lower
        total, spare = sum(after.values()), sum(cut[min(m, 3) - 1] for m in after.values())
        own = after.get(code, 0)
        return (max(0.0, own - cut[min(own, 3) - 1]) if own else 0.0) / total + spare / total * lower

    return probability


def test_perplexity(documents):
    texts = ["the cat sat.\nthe dog", "a dog and a cat, 12!", "été à la mer", "the the", None, ""]
    docs = documents(texts)
    model = quality.KneserNey(*quality.fit(docs))
    want = plain_kneser_ney([x or "" for x in texts])
    codes = np.append(quality.grams([x or "" for x in texts])[0], [0, 5, quality.CLASSES**4 - 1, 123_456])
    got = model.log_probability(codes)
    assert np.allclose(got, [math.log(want(int(c), quality.ORDER)) for c in codes], atol=1e-5)
    for context in (0, 17, 400, 63_999):  # probabilities of all classes add up to 1
        assert abs(np.exp(model.log_probability(np.arange(40) + 40 * context)).sum() - 1) < 1e-4


def test_characters_of_all_planes_have_their_class():
    low, high = "\u4e00\u0663.a", "\U00020000\U0001d7d9\U0001f600\U00010400"  # a letter, a digit, ..; the same beyond the first plane
    codes = quality.grams([low + high])[0] % quality.CLASSES
    assert codes.tolist() == [32 + 0x4E00 % 8, 27, 29, 1, 32 + 0x20000 % 8, 27, 31, 32 + 0x10428 % 8]
    assert quality._class_table()[ord("\n")] == 28 and quality._class_table()[ord("~")] == 30


def plain_whole_logs(texts, order):
    """Logarithms by gram of whole characters, by dictionaries."""
    grams = {order: collections.Counter(x[i : i + order] for x in (" " * (order - 1) + t for t in texts) for i in range(len(x) - order + 1))}
    for n in range(order - 1, 0, -1):
        grams[n] = collections.Counter(g[1:] for g in grams[n + 1])

    def probability(gram):
        n = len(gram)
        if n == 0:
            return 1 / 0x110000
        of = [sum(c == k for c in grams[n].values()) for k in (1, 2, 3, 4)]
        y = of[0] / (of[0] + 2 * of[1]) if of[0] else 0.5
        cut = [min(0.95 * k, max(0.05, k - (k + 1) * y * of[k] / of[k - 1])) if of[k - 1] else 0.5 for k in (1, 2, 3)]
        after = [m for g, m in grams[n].items() if g[:-1] == gram[:-1]]
        own = grams[n][gram]
        return (own - cut[min(own, 3) - 1] + sum(cut[min(m, 3) - 1] for m in after) * probability(gram[1:])) / sum(after)

    return {g: math.log(probability(g)) for g in grams[order]}


def points_of(head, last, order):
    return "".join(chr(x >> 21 * i & 0x1FFFFF) for x, size in ((head, order - 2), (last, 2)) for i in range(size - 1, -1, -1))


ODD_TEXTS = ["The cat sat.\nThe dog", "the cat, 12! 21?", "\u4e00\u4e08\u4e00 \u0434\u043e\u043c \u0434\u043e\u043c", "\U0001f600\0\0\0\0\0\0", "the the", None, "", "ÉTÉ été"]


def test_whole_characters_have_kneser_ney_probabilities(documents):
    for order in (2, 4, 5):
        want = plain_whole_logs([x or "" for x in ODD_TEXTS], order)
        table = quality.whole_logs(quality.count_whole(documents(ODD_TEXTS), order=order), order).collect()
        got = {points_of(r["head"], r["last"], order): r.log for r in table}
        assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-4 for g in want)


def test_grams_of_many_kinds_of_characters():
    random.seed(4)
    few, many = "abcab \U0001f600", [chr(random.randrange(0x4E00, 0xE000 - 0x800)) for _ in range(9000)]  # over 2^12 kinds: in two parts
    for texts in ([few, "", few * 3], ["".join(many), "".join(many[:99])]):
        head, last, count = quality.distinct_grams(texts, 5)
        every = collections.Counter(x[i : i + 5] for x in ("    " + t for t in texts) for i in range(len(x) - 4))
        assert {points_of(int(h), int(k), 5): int(c) for h, k, c in zip(head, last, count)} == every
        head, last, ends = quality.whole_grams(texts, 5)
        assert [points_of(int(h), int(k), 5) for h, k in zip(head, last)] == [x[i : i + 5] for x in ("    " + t for t in texts) for i in range(len(x) - 4)]
        assert ends.tolist() == np.cumsum([len(x) for x in texts]).tolist()


def test_logs_of_grams_whose_slot_is_taken():
    random = np.random.default_rng(3)
    head, last = (random.permutation(1 << 16).astype(np.int64) for _ in range(2))
    values = random.random(1 << 16).astype(np.float32)
    logs = quality.Logs(head, last, values)
    assert len(logs.left_keys) > 1000 and (logs(head, last) == values).all()
    assert len(quality.Logs(head[:0], last[:0], values[:0])(head[:0], last[:0])) == 0


def cyrillic(n, seed):
    random.seed(seed)
    syllables = [a + b for a in "вдлмнрст" for b in "аеио"]
    return " ".join("".join(random.choices(syllables, k=random.randint(1, 3))) for _ in range(n))


def test_letters_that_fold_alike_are_told_apart(documents):
    texts = [cyrillic(80, i) for i in range(120)]
    other = str.maketrans({c: chr(ord(c) + 8 if ord(c) < 0x448 else ord(c) - 8) for c in "вдлмнрстаеио"})
    odd = cyrillic(80, 500).translate(other)  # of other letters, which fall into the same classes
    plain = cyrillic(80, 500)
    assert (quality.grams([odd])[0] == quality.grams([plain])[0]).all()
    rows = {r.doc_id: r for r in quality.quality(documents([*texts, plain, odd])).collect()}
    assert rows[120].kept and not rows[120].base_failed
    assert not rows[121].kept and not rows[121].base_failed and abs(rows[121].log_ppl - rows[120].log_ppl) > 0.1


def test_grams_beyond_what_tasks_hold_are_joined(spark, documents, monkeypatch):
    texts = [*ODD_TEXTS, *(cyrillic(60, i) for i in range(30)), "x" * 3000, "", None]
    docs = documents([*texts, *texts])
    want = {r.doc_id: r for r in quality.quality(docs).collect()}
    monkeypatch.setattr(quality, "HELD_GRAMS", 0)
    monkeypatch.setattr(quality, "JOINED_BYTES", 1 << 11)
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    assert got.keys() == want.keys() and len(got) == 2 * len(texts)
    assert all(tuple(got[i])[:-1] == tuple(want[i])[:-1] and abs(got[i].log_ppl - want[i].log_ppl) < 1e-9 for i in want)
    assert quality.quality(docs.limit(0)).count() == 0
    judged = quality.judge(docs, ["doc_id"], with_text=True).collect()
    assert {(r.row.doc_id, r.text) for r in judged} == {(i, x) for i, x in enumerate([*texts, *texts])}


def test_quality_documents(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in quality.quality(load(spark, sf_dir)).collect()}
    texts = {r.doc_id: r.text for r in load(spark, sf_dir).collect()}
    for i, text in texts.items():
        m, r = plain_measures(text), rows[i]
        assert tuple(r)[1:6] == m and r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and not (r.kept and r.base_failed)
    good = load(spark, sf_dir, "labels").where("quality = 1").collect()
    assert all(rows[r.doc_id].kept or rows[r.doc_id].base_failed for r in good if r.doc_id in rows)
    odd = quality.quality(documents([None, "", " \n", "a b c " * 30, "a b c " * 30])).collect()
    assert len(odd) == 5 and not any(r.kept for r in odd)
    assert quality.quality(documents(["x"]).limit(0)).count() == 0


def test_mixing_meets_its_targets(spark, sf_dir):
    docs = load(spark, sf_dir)
    mixed = mixing.weights(docs)
    assert differences(mixed.columns, mixed.collect(), connect(sf_dir), oracles.mixing_sql()) is None
    rows = mixed.toPandas()
    for margin, power in mixing.TEMPER.items():
        own = rows.groupby(margin).n_tokens.sum()
        expected = (rows.n_tokens * rows.weight).groupby(rows[margin]).sum()
        target = own**power / (own**power).sum()
        assert np.allclose(expected / expected.sum(), target, atol=2e-3)


def test_mixing_odd_rows(spark, documents):
    docs = documents([None, "", "a b", "a b", "| | |"] * 8).withColumnRenamed("n_words", "tokens").withColumnRenamed("row", "probability")
    rows = mixing.mix(docs, ["doc_id", "tokens", "probability"]).collect()
    assert len(rows) == 40 and all(0 < r.probability <= 1 for r in rows)
    targets = {"source": spark.createDataFrame([("src0", 1.0)], "source string, target double")}
    only = mixing.mix(docs, ["doc_id"], targets=targets).collect()
    assert {r.source for r in only if r.kept} == {"src0"} and all(r.probability == 0 for r in only if r.source != "src0")
    assert mixing.mix(docs.limit(0), ["doc_id"]).count() == 0


def test_a_tail_source_leaves_the_hot_one_its_share(spark):
    hot = [(i, f"w{i} " * 50, "hot", "en") for i in range(2000)]
    docs = spark.createDataFrame([*hot, (5000, "few words", "tail", "en"), (5001, None, None, "en")], "doc_id long, text string, source string, lang string")
    rows = mixing.weights(docs).collect()
    kept = {s: [r for r in rows if r.source == s and r.kept] for s in ("hot", "tail", None)}
    assert len(kept["hot"]) > 1900 and len(kept["tail"]) == 1 and len(kept[None]) == 1
    assert kept["tail"][0].copies == mixing.MOST_COPIES and all(r.probability > 0 for r in rows)
    # the tail's target can't be reached by four copies, and the report says so
    told = {(r.margin, r.value): r for r in mixing.margins(mixing.mix(docs, ["doc_id"])).collect()}
    tail = told["source", "tail"]
    assert tail.wanted < tail.target and abs(told["source", "hot"].wanted - told["source", "hot"].target) < 0.02


def test_margins_of_what_is_drawn(spark, sf_dir):
    for r in mixing.margins(mixing.mix(load(spark, sf_dir), ["doc_id"])).collect():
        assert abs(r.wanted - r.target) < 2e-3 and abs(r.drawn - r.target) < 0.1


def test_rounds_go_on_until_a_tolerance(spark):
    cells = spark.createDataFrame([("a", "x", 900), ("a", "y", 10), ("b", "x", 10), ("b", "y", 1)], "source string, lang string, tokens long")
    targets = {"source": spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, target double"), "lang": spark.createDataFrame([("x", 0.5), ("y", 0.5)], "lang string, target double")}
    short, long = mixing.rake(cells, targets, rounds=1), mixing.rake(cells, targets, rounds=1, tolerance=1e-9)
    share = lambda t: sum(r.fitted for r in t.collect() if r.source == "a")
    assert abs(share(long) - 0.5) < 1e-9 < abs(share(short) - 0.5)
