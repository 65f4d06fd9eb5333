"""Sampling sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The cells' token weights are raked: scaled to the targets of one
margin after the other, round after round, which keeps the cells' interaction and ends where all three margins are met.
A document's weight is how often it is wanted: its cell's fitted share of `keep` times the corpus's tokens, over the cell's
tokens. So what is drawn has `keep` times the corpus's tokens and the target shares, whatever the smallest cell. A weight
under 1 is a probability; of a weight over 1 the whole part are sure copies, and the rest is the probability of one more.
Weights over `most_copies` are cut there, and `margins` reports what each margin's value was to have and what it reaches.
A hash of the id is the dice, so the same rows are drawn again after a failure.

A margin's targets are given as a table, or are the margin's own shares raised to a power under 1, which lifts rare
values. Targets that contradict each other (a source that is all of a topic, with another share) are met as far as raking
gets; `margins` tells. A null source or language is a value of its own. A document has its words and one end as tokens, so
empty and null texts count 1. Documents of equal id are drawn together. No rows: an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.staging import settle

#: Powers of the margins' own shares.
TEMPER = {"source": 0.7, "lang": 0.85, "topic": 0.95}
ROUNDS = 20
#: Rounds at most where a tolerance is asked for.
MOST_ROUNDS = 500
#: Tokens drawn, as a share of the corpus's.
KEEP = 1.0
#: Copies of a document at most.
MOST_COPIES = 4
MARGINS = ("source", "lang", "topic")
#: Rounds that are one plan; what they give is written before the next.
ROUNDS_A_PLAN = 5
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def topic(text: Column, n_words: Column) -> Column:
    """What a text is like, where no column says it: a table, lines, or prose by length."""
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return (
        F.when(n_words == 0, "empty")
        .when(10 * bars >= n_words, "table")
        .when(8 * lines >= n_words, "lines")
        .when(n_words < 100, "note")
        .when(n_words < 1000, "article")
        .otherwise("book")
    )


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """The margin's values with their target shares: own shares to a power, scaled to add up to 1."""
    own = cells.groupBy(margin).agg(F.sum("tokens").alias("own"))
    raised = own.select(margin, F.pow(F.col("own").cast("double"), F.lit(power)).alias("raised"))
    total = raised.agg(F.sum("raised")).first()[0]
    return raised.select(margin, (F.col("raised") / F.lit(total)).alias("target"))


def _sums(cells: DataFrame, margin: str, value: str) -> DataFrame:
    """A margin's sums, one small row for each of its values; combined in every task before the shuffle."""
    return cells.groupBy(F.col(margin).alias("_value")).agg(F.sum(value).alias("_sum"))


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float | None = None
) -> DataFrame:
    """The cells with `fitted`, weights whose sums by margin are the targets.

    A cell of which a margin's value has no target gets 0. The rounds are fixed, so the outcome is too; with a `tolerance`
    more follow until no margin's value is further from its target, MOST_ROUNDS in all.
    """
    start = cells.withColumn("fitted", F.col("tokens").cast("double"))
    for margin, table in targets.items():
        named = table.select(F.col(margin).alias("_value"), F.col("target").alias(f"_{margin}"))
        start = start.join(named, F.col(margin).eqNullSafe(F.col("_value")), "left").drop("_value")
        start = start.withColumn(f"_{margin}", F.coalesce(f"_{margin}", F.lit(0.0)))
    done = 0
    while done < rounds or (tolerance is not None and done < MOST_ROUNDS and _furthest(start, targets) > tolerance):
        for _ in range(min(ROUNDS_A_PLAN, rounds - done) if done < rounds else ROUNDS_A_PLAN):
            for margin in targets:
                joined = start.join(_sums(start, margin, "fitted"), F.col(margin).eqNullSafe(F.col("_value")))
                scaled = F.when(F.col("_sum") > 0, F.col("fitted") * F.col(f"_{margin}") / F.col("_sum")).otherwise(F.lit(0.0))
                start = joined.withColumn("fitted", scaled).drop("_sum", "_value")
                if margin != list(targets)[-1]:
                    start = settle(start, "mixing-weights")
            done += 1
            start = settle(start, "mixing-weights")
    return start.drop(*(f"_{m}" for m in targets))


def _furthest(cells: DataFrame, targets: dict[str, DataFrame]) -> float:
    """How far the furthest value of a margin is from its target."""
    gaps = [cells.groupBy(m).agg(F.abs(F.sum("fitted") - F.max(f"_{m}")).alias("gap")).select("gap") for m in targets]
    return reduce(DataFrame.unionByName, gaps).agg(F.max("gap")).first()[0] or 0.0


def dice(key: Column) -> Column:
    """A number in [0, 1) from 52 bits of the key's MD5; a null key has one too."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(
    docs: DataFrame,
    carry: list[str],
    temper: dict[str, float] | None = None,
    targets: dict[str, DataFrame] | None = None,
    rounds: int = ROUNDS,
    tolerance: float | None = None,
    keep: float = KEEP,
    most_copies: int = MOST_COPIES,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic_col: str | None = None,
) -> DataFrame:
    """`row` (the carried columns), source, lang, topic, tokens, probability, weight, copies and kept of every document."""
    rows = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"),
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).alias("text"),
        (F.col(topic_col) if topic_col else F.lit(None)).cast("string").alias("topic"),
        words(F.col(text_col)).alias("n"),
    )
    named = F.col("topic") if topic_col else topic(F.coalesce(F.col("text"), F.lit("")), F.col("n"))
    rows = rows.select("row", "id", "source", "lang", named.alias("topic"), (F.col("n") + 1).alias("tokens"))
    cells = settle(rows.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")), "mixing-cells")
    if targets is None:
        targets = {m: tempered(cells, m, p) for m, p in (temper or TEMPER).items()}
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    fitted = rake(cells, targets, rounds, tolerance)
    wanted = F.col("fitted") * F.lit(float(keep * total)) / F.col("tokens")
    weight = F.least(wanted, F.lit(float(most_copies))).alias("weight")
    odds = settle(fitted.select(*[F.col(m).alias(f"_{m}") for m in MARGINS], weight), "mixing-odds")
    same = [F.col(m).eqNullSafe(F.col(f"_{m}")) for m in MARGINS]
    drawn = rows.join(odds, same[0] & same[1] & same[2], "left")
    sure = F.floor("weight")
    copies = (sure + (dice(F.col("id")) < F.col("weight") - sure).cast("long")).alias("copies")
    drawn = drawn.select("row", *MARGINS, "tokens", F.least("weight", F.lit(1.0)).alias("probability"), "weight", copies)
    return drawn.withColumn("kept", F.col("copies") > 0)


def margins(mixed: DataFrame, targets: dict[str, DataFrame] | None = None, temper: dict[str, float] | None = None) -> DataFrame:
    """margin, value, its target share, and its shares of the tokens that weights want and that copies hold, of a result of
    `mix` (with the same targets or powers)."""
    cells = mixed.groupBy(*MARGINS).agg(
        F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("weight")).alias("wanted"), F.sum(F.col("tokens") * F.col("copies")).alias("drawn")
    )
    cells = settle(cells, "mixing-margins")
    if targets is None:
        targets = {m: tempered(cells, m, p) for m, p in (temper or TEMPER).items()}
    whole = cells.agg(F.sum("wanted").alias("w"), F.sum("drawn").alias("d")).first()
    parts = []
    for margin, table in targets.items():
        sums = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("wanted").alias("wanted"), F.sum("drawn").alias("drawn"))
        aims = table.select(F.col(margin).alias("_value"), "target")
        joined = sums.join(aims, F.col("value").eqNullSafe(F.col("_value")), "left")
        parts.append(
            joined.select(
                F.lit(margin).alias("margin"),
                "value",
                F.coalesce("target", F.lit(0.0)).alias("target"),
                F.try_divide("wanted", F.lit(whole["w"])).alias("wanted"),
                F.try_divide(F.col("drawn").cast("double"), F.lit(whole["d"]).cast("double")).alias("drawn"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def weights(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability, kept, weight and copies of every document."""
    return mix(docs, ["doc_id"]).select(
        "row.doc_id", *MARGINS, F.col("tokens").alias("n_tokens"), "probability", "kept", "weight", "copies"
    )
