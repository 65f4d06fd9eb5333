"""The pipeline's stages on their own input, and the registered queries."""

import re

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from test_duplicates import plain_components
from tidemark.llm import byte_bpe, mixing, queries, quality, suffix_dedup
from tidemark.llm.documents import load
from tidemark.sources.staging import settle


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = load(spark, sf_dir), []
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, docs, sf_dir), "stage")
        out.append((docs, after))
        docs = after
    return out


def test_stages_keep_the_columns(stages):
    assert all(a.columns == b.columns and dict(a.dtypes) == dict(b.dtypes) for a, b in stages[:-1])


def test_quality_stage(stages):
    docs, after = stages[0]
    want = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    assert {r.doc_id for r in after.collect()} == want
    assert after.exceptAll(docs).count() == 0


def test_join_stage(stages):
    docs, after = stages[1]
    rows = docs.collect()
    found = plain_components([r.doc_id for r in rows], [r.text for r in rows])
    assert {r.doc_id for r in after.collect()} == {i for i, (_, c) in found.items() if i == c}


def test_repeat_stage(stages):
    docs, after = stages[2]
    size = corpus_pipeline.PASSAGE_BYTES
    raw = {r.doc_id: r.text.encode() for r in docs.collect()}
    seen: dict[bytes, int] = {}
    for t in raw.values():
        for i in range(len(t) - size + 1):
            seen[t[i : i + size]] = seen.get(t[i : i + size], 0) + 1
    got = {r.doc_id: r for r in after.collect()}
    for i, t in raw.items():
        mask = bytearray(len(t))
        for j in range(len(t) - size + 1):
            if seen[t[j : j + size]] > 1:
                mask[j : j + size] = b"\1" * size
        kept, at = [], 0
        for c in t.decode():
            n = len(c.encode())
            if not all(mask[at : at + n]):
                kept.append(c)
            at += n
        text = "".join(kept)
        if re.search(r"[^\x20\x09-\x0D]", text):
            assert got[i].text == text and got[i].n_chars == len(text)
        else:
            assert i not in got


def test_short_words_of_a_passage(spark, monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyz"
    passage = " ".join(letters[i * i % 26] + letters[i % 26] * (i % 2) for i in range(51))  # 51 words, 126 bytes
    fifty = " ".join(letters[(i * 7 + i // 26) % 26] for i in range(50))
    alone = " ".join(letters[(i * i * i + 3) % 26] for i in range(60))
    texts = ["one " + passage + " two", "é\n" + passage + "\tthree", passage + "four", "five " + fifty, "six " + fifty, alone, passage]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string").repartition(3)
    for size in (1 << 19, 7):  # texts whole and in parts
        monkeypatch.setattr(suffix_dedup, "PART_BYTES", size)
        got = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
        assert got == {0: "one  two", 1: "é\n\tthree", 2: texts[2], 3: texts[3], 4: texts[4], 5: alone}


def test_mixing_stage(stages):
    docs, after = stages[3]
    want = {r.doc_id for r in mixing.weights(docs).where("kept").collect()}
    assert {r.doc_id for r in after.collect()} == want and after.exceptAll(docs).count() == 0


def test_encoding_stage(stages):
    docs, after = stages[4]
    ranks = byte_bpe.coder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r.n_tokens for r in after.collect()}
    assert got == {r.doc_id: len(library.encode_ordinary(r.text)) for r in docs.collect()}


def test_stages_take_odd_documents(spark, documents):
    docs = documents([None, "", "a b", "a b", "word " * 80, "word " * 80]).select("doc_id", "text", "lang", "source", "n_words", "row")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, docs.limit(0), "").count() == 0


def test_every_operator_is_registered():
    names = list(queries.registered())
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14))
    assert set(queries.all_sql()) <= set(names)


def test_join_stage_where_ids_repeat_or_are_null(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyz")
    rows = [(3, x), (5, x + " end"), (5, y), (None, x), (None, y + " end"), (None, z), (None, z + " end"), (9, None), (9, None), (None, ""), (7, z.upper())]
    docs = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    after = corpus_pipeline.keep_one_of_each(spark, docs, "")
    assert after.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in after.collect()) == sorted([("3", x), ("5", y), ("7", z.upper()), ("9", "None"), ("None", "")])
    only = docs.where("doc_id is null and text <> ''")
    assert sorted(r.text.split()[0] for r in corpus_pipeline.keep_one_of_each(spark, only, "").collect()) == ["x0", "y0", "z0"]
