"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Tokens (words) are summed by cell (source, lang, topic). Raking scales the cells' weights to each marginal in
turn until all three fit: after it, weight times tokens has the target share for every source, language and
topic. A cell's probability is its weight times one factor, at most 1, with the factor chosen so that the
expected tokens are ``BUDGET`` of all; a document is drawn if a number made from its id and text by hashing falls
below its cell's probability, so runs repeat exactly and need no state.

Without given targets a marginal's target shares are its own shares to the power of ``TEMPER``, which flattens
large sources. Only the cells enter the raking, never documents; cells pre-aggregate in every task, so a source
with a third of all rows is one row a task. The cells are broadcast to the documents if there are ``MAX_CELLS``
at most, and joined by shuffle beyond.

Defined cases: null or empty texts have no tokens and the topic "empty"; nulls of a marginal are the value "";
a value without a target keeps its own share of what the targets leave; cells without tokens have the weight 1;
rows that repeat a doc_id are drawn each by their text, equal rows alike; other columns are kept as they are;
an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystone.llm.families import scratch

MARGINS = ("source", "lang", "topic")
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 1.0}
#: Share of all tokens that the sample has in expectation.
BUDGET = 0.6
#: Raking ends when no share is further from its target than this, or after so many rounds.
TOLERANCE, ROUNDS = 1e-4, 24
MAX_CELLS = 100_000
SEED = 17
_BLANKS = "\t\n\x0b\f\r"


def topic_of(text: Column) -> Column:
    """Topic by plain signs in the text: empty, table (cells set apart by bars), notice (licence words), list
    (several lines that begin with a dash) or prose."""
    lower = F.lower(text)
    return (F.when(F.coalesce(F.trim(text), F.lit("")) == "", "empty")
            .when(F.contains(text, F.lit(" | ")), "table")
            .when(F.contains(lower, F.lit("license")) | F.contains(lower, F.lit("copyright")), "notice")
            .when(F.contains(text, F.lit("\n- ")), "list")
            .otherwise("prose"))


def n_tokens(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), _BLANKS, " " * len(_BLANKS))
    return F.size(F.filter(F.split(plain, " ", -1), lambda x: x != "")).cast("long")


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents as a struct (their columns may have any names), with cell, tokens and a number in 0 to 1."""
    text = F.col("text").cast("string")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    number = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("doc_id"), text), 11) / F.lit(float(1 << 53))
    return docs.select(
        row.alias("row"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), topic_of(text).alias("topic"),
        n_tokens(text).alias("tokens"), number.alias("draw"))


def with_targets(cells: DataFrame, targets: dict[str, dict[str, float]] | None) -> DataFrame:
    """Cells (source, lang, topic, tokens) with the target share of each marginal's value: target_source, ..."""
    whole = cells.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    for margin in MARGINS:
        given = (targets or {}).get(margin)
        sums = cells.groupBy(margin).agg(F.sum("tokens").alias("n")).where("n > 0")
        if given is None:
            sums = sums.withColumn("goal", F.pow(F.col("n").cast("double") / max(whole, 1), F.lit(TEMPER[margin])))
        else:
            left = max(0.0, 1 - sum(given.values()))
            wanted = F.create_map(*[F.lit(x) for kv in given.items() for x in kv])[F.col(margin)] if given else F.lit(None)
            sums = sums.withColumn("goal", F.coalesce(wanted.cast("double"), F.col("n") / max(whole, 1) * left))
        goals = scratch(sums.select(margin, "goal"), "goals")
        total = goals.agg(F.sum("goal").alias("s")).first()["s"] or 1.0
        cells = cells.join(goals.select(margin, (F.col("goal") / total).alias(f"target_{margin}")), margin, "left")
    return cells


def rake(cells: DataFrame, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells with targets -> the same with weight: shares of weight * tokens fit every marginal's targets."""
    now = scratch(cells.withColumn("weight", F.lit(1.0)), "raked")
    whole = float(cells.agg(F.sum("tokens").alias("n")).first()["n"] or 0)
    for _ in range(rounds if whole else 0):
        for margin in MARGINS:
            mass = F.sum(F.col("weight") * F.col("tokens")).over(Window.partitionBy(margin))
            now = now.withColumn("weight", F.when(
                F.col("tokens") > 0, F.col("weight") * F.col(f"target_{margin}") * F.lit(whole) / mass).otherwise(F.lit(1.0)))
        now = scratch(now, "raked")
        off = [now.groupBy(m).agg(F.abs(F.sum(F.col("weight") * F.col("tokens")) / F.lit(whole)
                                        - F.first(f"target_{m}", True)).alias("off")) for m in MARGINS[:-1]]
        worst = off[0].unionByName(off[1].withColumnRenamed(MARGINS[1], MARGINS[0])).agg(F.max("off").alias("w"))
        if (worst.first()["w"] or 0.0) <= tolerance:
            break
    return now


def with_probabilities(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Weighted cells with probability: weight times one factor, at most 1, for ``budget`` of the tokens."""
    whole = float(cells.agg(F.sum("tokens").alias("n")).first()["n"] or 0)
    factor = budget
    for _ in range(40):
        capped = F.col("weight") * F.lit(factor) >= 1
        got = cells.where("tokens > 0").agg(
            F.sum(F.when(capped, F.col("tokens"))).alias("full"),
            F.sum(F.when(~capped, F.col("weight") * F.col("tokens"))).alias("open")).first()
        if not got["open"]:
            break
        better = max(0.0, budget * whole - (got["full"] or 0)) / got["open"]
        if abs(better - factor) <= 1e-9 * factor:
            break
        factor = better
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(factor)))


def mix_sources(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET) -> DataFrame:
    """(row, source, lang, topic, tokens, weight, probability, kept) for each row of docs (doc_id, text, source, lang
    and others): row is a struct of all its columns."""
    keyed = _keyed(docs)
    cells = scratch(keyed.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    fitted = scratch(with_probabilities(rake(with_targets(cells, targets)), budget).select(
        *MARGINS, "weight", "probability"), "fitted")
    small = fitted.count() <= MAX_CELLS
    drawn = keyed.join(F.broadcast(fitted) if small else fitted, list(MARGINS))
    return drawn.select("row", *MARGINS, "tokens", "weight", "probability",
                        (F.col("draw") < F.col("probability")).alias("kept"))
