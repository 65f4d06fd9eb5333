"""The corpus pipeline: documents through one stage after another, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, mixing, ngram_join, quality, suffix_dedup
from tidemark.llm.documents import load
from tidemark.sources.staging import settle

#: Bytes of a repeated passage that is cut: fewer than 50 words of ordinary prose take. A passage of so many words is cut
#: however few bytes it has.
PASSAGE_BYTES = 240
PASSAGE_WORDS = 51

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "text"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts fail them; repeated rows are judged alike, and all of them
    stay or go; a null language is judged as one."""
    judged = quality.judge(docs, _others(docs), with_text=True).where("kept")
    return judged.select(*["text" if c == "text" else f"row.{c}" for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: that of smallest id (null ids last), then of least hash of its text; of
    rows equal in both, one. Documents without words are in no component and stay; null and empty texts are such."""
    found = ngram_join.near_duplicates(docs)
    order = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "text_hash")
    least = found.where("n_shingles > 0").groupBy("c", "d").agg(F.min(order).alias("least")).select("least.doc_id", "least.text_hash")
    stays = least.union(found.where("n_shingles = 0").select("doc_id", "text_hash").distinct())
    stays = stays.select(F.col("doc_id").alias("_first"), F.col("text_hash").alias("_hash"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_first")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_hash"))
    kept = docs.join(stays, same, "left_semi")
    again = Window.partitionBy("doc_id", "text").orderBy(*[c for c in _others(docs) if c != "doc_id"])
    return kept.withColumn("_again", F.row_number().over(again)).where("_again = 1").drop("_again")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the repeated passages of PASSAGE_BYTES or PASSAGE_WORDS or more; a character that a passage covers in
    part stays, and documents of which no word is left go, as do null and empty texts. A row that repeats another is a repeat."""

    def whole(text: bytes, start: int, stop: int) -> tuple[int, int]:
        while start < stop and text[start] & 0xC0 == 0x80:
            start += 1
        while start < stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop -= 1
        return start, stop

    def finish(piece: pa.RecordBatch, runs: list[list[tuple[int, int]]]) -> pa.RecordBatch:
        texts = piece.column("text").to_pylist()
        kept = [suffix_dedup.kept_parts(x, [whole(x, *r) for r in cut]).decode() for x, cut in zip(texts, runs)]
        return pa.RecordBatch.from_arrays([piece.column("row"), pa.array(kept, pa.string())], ["row", "text"])

    row = docs.select(F.struct(*_others(docs)).alias("row")).schema["row"].dataType.simpleString()
    cut = suffix_dedup.deduplicate(docs, _others(docs), finish, f"row {row}, text string", PASSAGE_BYTES, words=PASSAGE_WORDS)
    columns = {c: F.col("text") if c == "text" else F.col(f"row.{c}") for c in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.where(r"text rlike '[^\\x20\\x09-\\x0D]'").select(*[x.alias(c) for c, x in columns.items()])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target shares of sources, languages and topics, once each however many copies are wanted. Null
    sources and languages are values of their own; rows of one id stay or go together."""
    return mixing.mix(docs, docs.columns).where("kept").select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and digests of the ids and of the text that they decode to; a null text is empty. Every row has its
    row of the result."""
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokenize),
]
#: SQL can't state these stages (a trained model, suffix arrays, byte-level BPE); the tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages."""
    docs = load(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
