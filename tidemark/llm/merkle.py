"""A Merkle manifest of a table, and proofs of its rows computed for whole leaf partitions at a time.

Every row is a leaf: the SHA-256 of its fields, each as its UTF-8 byte count, a colon and its value, or `-` for null. The
leaves of a language ascend by id; two neighbours at a time (the last one alone if need be) become the digest of their hex
texts, until one is left, the language's subroot. The subroots, ordered by language, give the root in the same way.

Leaves get their places from a range partitioning and the counts of its parts, so no task sorts a whole language. A *leaf
partition* is an aligned block of 2^BLOCK_LEVELS leaves of one tree. It climbs its levels alone, and the blocks' tops are
blocks of leaves of the next story; 2^40 leaves take four stories. All inner nodes are stored by tree, level and place.

Proofs are octopus multiproofs. A leaf partition works out the smallest set of coordinates that its leaves lack together
(siblings that neither it holds nor its leaves imply), fetches these once by a join against the stored nodes, derives the
inner nodes that its leaves share, and expands each leaf's proof from them.

Null ids come first and count as the empty text where an id's checksum decides. Rows that repeat an id are told apart by
their leaf digests; equal rows are leaves of their own with equal leaf and root but proofs of their own places. A null
language is a tree of its own and comes first. Null or empty texts are fields like others. Columns other than the five
are not looked at, whatever their names. An empty table has an empty manifest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.documents import ship
from tidemark.sources.staging import settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A leaf partition holds 2^BLOCK_LEVELS leaves at most.
BLOCK_LEVELS = 10
#: Rows with ids whose checksum this divides are tampered with when the manifest is tried.
TAMPERED = 7

NODES = "tree string, level int, place long, digest binary"
PATH = "array<struct<digest:binary,is_left:boolean>>"
VERIFIED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
Path = list[tuple[bytes, bool]]


class Manifest(NamedTuple):
    """Leaf partitions, stored inner nodes, and the subroot and size of each tree."""

    blocks: DataFrame
    nodes: DataFrame
    trees: DataFrame


# --- leaves ----------------------------------------------------------------------------


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**fields: Column) -> Column:
    """The leaf of a row, 32 bytes; `fields` replace columns of the row."""
    return F.unhex(F.sha2(F.concat(*[_field(fields.get(x, F.col(x))) for x in FIELDS]).cast("binary"), 256))


def checksum(doc_id: Column) -> Column:
    """The unsigned CRC-32 of a decimal id."""
    return F.crc32(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")).cast("binary"))


def tree_of(lang: Column) -> Column:
    """A name that is never null and sorts as languages do, null first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


# --- building --------------------------------------------------------------------------


def _height(size: int) -> int:
    return (size - 1).bit_length()


def _width(size: int, level: int) -> int:
    """How many nodes a level of a tree of `size` leaves has."""
    return -(-size >> level)


def _parent(left: bytes, right: bytes | None) -> bytes:
    return sha256(left.hex().encode() + (right.hex().encode() if right is not None else b"")).digest()


def _above(nodes: dict[int, bytes], size: int) -> dict[int, bytes]:
    """The nodes over those of one level, of which there are `size`, as far as these and no others imply them."""
    out = {}
    for place in {x >> 1 for x in nodes}:
        left, right = nodes.get(2 * place), nodes.get(2 * place + 1)
        if left is not None and (right is not None or 2 * place + 1 >= size):
            out[place] = _parent(left, right)
    return out


def number(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows with their `place` in their `tree`, by `order`, and the tree's `size`."""
    part = F.spark_partition_id().alias("part")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")
    sorted_rows = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = settle(sorted_rows.select("*", part, at), f"{name}-placed")
    parts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("size"))
    parts = settle(parts, f"{name}-parts")
    return placed.join(parts, ["tree", "part"]).withColumn("place", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _blocks(rows: DataFrame, carry: list[str]) -> DataFrame:
    """Leaf partitions: the leaves of a block, in no order, in one row."""
    block = F.shiftright("place", BLOCK_LEVELS).alias("block")
    leaves = F.collect_list(F.struct("place", "digest", *carry)).alias("leaves")
    return rows.groupBy("tree", block).agg(F.first("size").alias("size"), leaves)


def _climb(blocks: DataFrame, base: int) -> DataFrame:
    """The nodes that blocks of nodes of level `base` give on the BLOCK_LEVELS levels above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees, levels, places, digests = [], [], [], []
            for row in batch.to_pylist():
                nodes = {x["place"]: x["digest"] for x in row["leaves"]}
                for level in range(base, min(base + BLOCK_LEVELS, _height(row["size"]))):
                    nodes = _above(nodes, _width(row["size"], level))
                    trees += [row["tree"]] * len(nodes)
                    levels += [level + 1] * len(nodes)
                    places += nodes.keys()
                    digests += nodes.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(trees, pa.string()), pa.array(levels, pa.int32()), pa.array(places, pa.int64()), pa.array(digests, pa.binary())],
                ["tree", "level", "place", "digest"],
            )

    return blocks.mapInArrow(run, NODES)


def grow(rows: DataFrame, carry: list[str], order: list[str], name: str) -> Manifest:
    """The trees over rows of `tree` and `digest`, whose other columns `carry` stay with the leaves."""
    ship(rows.sparkSession)
    blocks = settle(_blocks(number(rows, order, name), carry), f"{name}-blocks")
    largest = blocks.agg(F.max("size")).first()[0] or 1
    sizes = blocks.select("tree", "size").distinct()
    nodes = settle(_climb(blocks, 0), f"{name}-nodes")
    for base in range(BLOCK_LEVELS, _height(largest), BLOCK_LEVELS):
        tops = nodes.where(F.col("level") == base).join(sizes, "tree")
        nodes = nodes.unionByName(settle(_climb(_blocks(tops, []), base), f"{name}-nodes"))
    # a lone leaf is its tree's subroot; else the only node of the highest level
    lone = blocks.where("size = 1").select("tree", "size", F.col("leaves")[0]["digest"].alias("subroot"))
    highest = nodes.groupBy("tree").agg(F.max_by("digest", "level").alias("subroot"))
    tall = highest.join(sizes, "tree").select("tree", "size", "subroot")
    return Manifest(blocks, nodes, settle(lone.unionByName(tall), f"{name}-trees"))


# --- proving ----------------------------------------------------------------------------


def missing(places: list[int], size: int) -> list[tuple[int, int]]:
    """The least set of (level, place) that leaves at `places` of a tree of `size` lack for all their proofs together."""
    known, out = set(places), []
    for level in range(_height(size)):
        out += [(level, x ^ 1) for x in sorted(known) if x ^ 1 < _width(size, level) and x ^ 1 not in known]
        known = {x >> 1 for x in known}
    return out


def expand(leaves: dict[int, bytes], lacked: dict[tuple[int, int], bytes], size: int) -> dict[int, Path]:
    """The path of each leaf, from the inner nodes that the leaves and the fetched nodes give together.

    A path has for each level, from the leaves up, the sibling (empty where there is none) and whether it is on the left.
    """
    nodes, held = dict(leaves), []
    for level in range(_height(size)):
        nodes |= {place: x for (of, place), x in lacked.items() if of == level}
        held.append(nodes)
        nodes = _above(nodes, _width(size, level))
    return {x: [(nodes.get(x >> level ^ 1, b""), bool(x >> level & 1)) for level, nodes in enumerate(held)] for x in leaves}


def fold(digest: bytes, path: Path) -> bytes:
    """The root that a leaf and its path lead to."""
    for sibling, is_left in path:
        if not sibling:
            digest = _parent(digest, None)
        else:
            digest = _parent(sibling, digest) if is_left else _parent(digest, sibling)
    return digest


def fetch(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """For each leaf partition the stored nodes that it lacks; it asks for each of them once."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [(r["tree"], r["block"], *at) for r in rows for at in missing(r["places"], r["size"])]
            columns, kinds = list(zip(*found)) or [()] * 4, (pa.string(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["tree", "block", "level", "place"])

    places = wanted.select("tree", "block", "size", F.transform("leaves", lambda x: x["place"]).alias("places"))
    asked = places.mapInArrow(ask, "tree string, block long, level int, place long")
    lacked = F.collect_list(F.struct("level", "place", "digest")).alias("lacked")
    return asked.join(stored, ["tree", "level", "place"]).groupBy("tree", "block").agg(lacked)


def prove(
    manifest: Manifest,
    finish: Callable[[dict, Path, bytes | None], dict],
    kinds: str,
    wanted: DataFrame | None = None,
    above: DataFrame | None = None,
) -> DataFrame:
    """What `finish` makes of each leaf (its place, digest and carried columns), its path and its subroot, as columns `kinds`.

    All leaves are proved, or those of `wanted`, blocks of which some leaves are left out. `above` holds the subroots by
    tree, and paths that go on from them; without it paths end at the subroots, which are not given.
    """
    if wanted is None:  # whole blocks lack no node of their own levels
        wanted, stored = manifest.blocks, manifest.nodes.where(F.col("level") >= BLOCK_LEVELS)
    else:
        leaves = manifest.blocks.select("tree", F.inline("leaves")).select("tree", F.lit(0).alias("level"), "place", "digest")
        stored = manifest.nodes.unionByName(leaves)
    ship(wanted.sparkSession)
    joined = wanted.join(fetch(wanted, stored), ["tree", "block"], "left")
    if above is None:
        joined = joined.select("*", F.lit(None).cast("binary").alias("subroot"), F.lit(None).cast(PATH).alias("path"))
    else:
        joined = joined.join(above, "tree")
    schema = to_arrow_schema(wanted.sparkSession.createDataFrame([], kinds).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a leaf partition at a time
                row = batch.slice(i, 1).to_pylist()[0]
                lacked = {(x["level"], x["place"]): x["digest"] for x in row["lacked"] or []}
                further = [(x["digest"], x["is_left"]) for x in row["path"] or []]
                paths = expand({x["place"]: x["digest"] for x in row["leaves"]}, lacked, row["size"])
                found = [finish(x, paths[x["place"]] + further, row["subroot"]) for x in row["leaves"]]
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    return joined.select("leaves", "size", "lacked", "path", "subroot").mapInArrow(run, kinds)


def _as_rows(path: Path) -> list[dict]:
    return [{"digest": x, "is_left": is_left} for x, is_left in path]


def top_of(manifest: Manifest, name: str) -> tuple[bytes | None, DataFrame]:
    """The root over the trees' subroots (none of an empty table), and each tree's subroot and path to the root."""
    rows = manifest.trees.select(F.lit("").alias("tree"), F.col("subroot").alias("digest"), F.col("tree").alias("name"))
    top = grow(rows, ["name"], ["name"], name)
    root = top.trees.first()

    def finish(leaf: dict, path: Path, subroot: bytes | None) -> dict:
        return {"tree": leaf["name"], "subroot": leaf["digest"], "path": _as_rows(path)}

    paths = prove(top, finish, f"tree string, subroot binary, path {PATH}")
    return (bytes(root["subroot"]) if root else None), settle(paths, f"{name}-paths")


def manifest_of(docs: DataFrame, carry: dict[str, Column] | None = None, name: str = "merkle") -> Manifest:
    """The manifest of documents; the leaves carry `doc_id` and the columns given."""
    rows = docs.select(
        tree_of(F.col("lang")).alias("tree"),
        leaf_digest().alias("digest"),
        F.col("doc_id").cast("long").alias("doc_id"),
        *[x.alias(c) for c, x in (carry or {}).items()],
    )
    return grow(rows, ["doc_id", *(carry or {})], ["doc_id", "digest"], name)


def verify(docs: DataFrame) -> DataFrame:
    """Every row's leaf, subroot, root, proof digest, and the root that its leaf, tampered with or not, folds to.

    Rows whose id's checksum TAMPERED divides have 1 added to n_chars (a null stays one and proves nothing wrong).
    """
    changed = F.when(checksum(F.col("doc_id")) % TAMPERED == 0, leaf_digest(n_chars=F.col("n_chars") + 1))
    manifest = manifest_of(docs, {"changed": changed})
    root, paths = top_of(manifest, "merkle-top")

    def finish(leaf: dict, path: Path, subroot: bytes | None) -> dict:
        folded = fold(leaf["changed"] or leaf["digest"], path)
        return {
            "doc_id": leaf["doc_id"],
            "leaf": leaf["digest"].hex(),
            "subroot": subroot.hex(),
            "root": root.hex(),
            "proof_sha256": sha256("".join(x.hex() for x, _ in path).encode()).hexdigest(),
            "folded_root": folded.hex(),
            "verified": folded == root,
        }

    return prove(manifest, finish, VERIFIED, above=paths)
