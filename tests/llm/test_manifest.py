"""The Merkle manifest against one built in plain Python, whole and for few leaves."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.documents import load


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    return h(*(field(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def climb(nodes):
    """All levels, and the siblings of each first node with their sides."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            path.append((level[i ^ 1], i & 1) if i ^ 1 < len(level) else None)
            i >>= 1
        paths.append(path)
    return levels[-1][0], paths


def fold(digest, path):
    for step in path:
        digest = h(digest) if step is None else h(step[0], digest) if step[1] else h(digest, step[0])
    return digest


def plain(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row["lang"], []).append(row)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for lang in order:
        leaves = sorted(trees[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        made[lang] = leaves, *climb([leaf_of(r) for r in leaves])
    root, tops = climb([made[x][1] for x in order])
    out = []
    for lang, top in zip(order, tops):
        leaves, subroot, paths = made[lang]
        for row, path in zip(leaves, paths):
            path = path + top
            other = dict(row)
            number = "" if row["doc_id"] is None else str(row["doc_id"])
            if zlib.crc32(number.encode()) % 7 == 0 and row["n_chars"] is not None:
                other["n_chars"] += 1
            folded = fold(leaf_of(other), path)
            proof = h(*(x[0] for x in path if x))
            out.append((row["doc_id"], leaf_of(row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def check(docs):
    rows = [r.asDict() for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = merkle.verify(docs)
    assert found.columns == [x.split()[0] for x in merkle.VERIFIED.split(", ")]
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)
    return rows


def test_whole_table(spark, sf_dir):
    rows = check(load(spark, sf_dir))
    assert len({r["lang"] for r in rows}) > 1


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_odd_rows(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    random.seed(levels)
    rows = [(i, random.choice(["s", None, "ü:1"]), "en" if i % 3 else "de", random.choice([None, i]), f"text {i}") for i in range(23)]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (5, "s", "en", 3, ""), (5, "s", "en", 4, "")]
    rows += [(7, "-", "", 1, "x" * 100_000), (70, "a", "zz", 2, "é\n" * 5), (70, "a", "zz", 2, "é\n" * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    check(docs.selectExpr("*", "1 as tree", "2 as place", "3 as size", "'x' as digest", "4 as part"))
    check(docs.where("doc_id = 70").limit(1))
    assert merkle.verify(docs.limit(0)).count() == 0


def test_proofs_of_few_leaves(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 4)
    manifest = merkle.manifest_of(load(spark, sf_dir))
    few = F.filter("leaves", lambda x: x["doc_id"] % 5 == 0)
    wanted = manifest.blocks.withColumn("leaves", few).where("size(leaves) > 0")

    def finish(leaf, path, subroot):
        return {"doc_id": leaf["doc_id"], "folded": merkle.fold(leaf["digest"], path), "subroot": subroot}

    root, paths = merkle.top_of(manifest, "few")
    found = merkle.prove(manifest, finish, "doc_id long, folded binary, subroot binary", wanted, paths).collect()
    assert {r.doc_id for r in found} == {r.doc_id for r in load(spark, sf_dir).collect() if r.doc_id % 5 == 0}
    assert all(r.folded == root for r in found)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 8, 21])
def test_missing_is_minimal(size):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(size)]
    root, want = climb([x.hex() for x in leaves])
    levels, nodes = [], dict(enumerate(leaves))
    for level in range(merkle._height(size)):
        levels.append(nodes)
        nodes = merkle._above(nodes, merkle._width(size, level))
    random.seed(size)
    for _ in range(30):
        places = random.sample(range(size), random.randint(1, size))
        asked = merkle.missing(places, size)
        lacked = {(level, place): levels[level][place] for level, place in asked}
        got = merkle.expand({x: leaves[x] for x in places}, lacked, size)
        for place, path in got.items():
            assert [(x.hex(), s) for x, s in path if x] == [(x[0], bool(x[1])) for x in want[place] if x]
            assert merkle.fold(leaves[place], path).hex() == root
        for one in asked:  # without any of them some path is not whole
            short = merkle.expand({x: leaves[x] for x in places}, {k: v for k, v in lacked.items() if k != one}, size)
            assert any(short[x] != got[x] for x in places)
