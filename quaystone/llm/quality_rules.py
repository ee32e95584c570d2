"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every rule rejects a text whose value exceeds a cutoff. Labelled holdout texts choose the cutoffs, for each
stratum (lang) and rule: a cutoff is valid if the exact binomial test shows that it rejects at most
``RISK`` / (number of rules) of the stratum's good texts, so all rules together reject at most ``RISK`` of them,
with a confidence of 1 - ``DELTA`` for all strata and rules at once (Bonferroni over strata and rules; a rule's
cutoffs are tested from the loosest on, which needs no further correction as false rejections only grow). Of the
valid cutoffs the one that rejects most bad texts is taken, and of equal ones the loosest. A stratum with too
few labelled texts to show the bound has no cutoff and rejects nothing.

All counts come from one scan, whose numbers are written to a scratch table; labels join that table, never the
texts. Repeated three-word windows are found in the row: their hashes are sorted, and only a text with equal
ones sorts them with their places.

Defined cases: null and empty texts have no words and fail the base rule; a null lang is a stratum of its own;
null labels and labels of unknown documents are ignored; repeated labels of a document count once, the smallest;
rows that repeat a doc_id each get a row and count with its label; a null doc_id stays null and has no label;
other columns are ignored; empty tables give an empty result or no cutoffs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaystone.llm.families import scratch

RISK = 0.02
DELTA = 0.05
SYMBOLS = "#*$%&|<>"
_BLANKS = "\t\n\x0b\f\r"
#: Cutoffs of every rule, from the loosest to the tightest.
CUTOFFS = {
    "symbols": [2.0, 1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05],
    "duplicate_lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1],
    "repeats": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1],
    "capitals": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
    "long_words": [40.0, 30.0, 20.0, 15.0, 12.0, 10.0],
}


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _values() -> dict[str, Column]:
    return {
        "symbols": _share("n_symbols", "n_words"),
        "duplicate_lines": _share("n_dup_lines", "n_lines"),
        "repeats": _share("n_repeat_words", "n_words"),
        "capitals": _share("n_capitals", "word_chars"),
        "long_words": _share("word_chars", "n_words"),
    }


def counts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_capitals) of each row
    of docs (doc_id, text, lang); words are runs of anything but space, \\t, \\n, \\v, \\f, \\r; lines are those
    with a word."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    without = lambda chars: F.length(F.translate("t", chars, ""))
    one = docs.select("doc_id", "lang", text.alias("t"))
    two = one.select(
        "doc_id", "lang",
        F.filter(F.split(F.translate("t", _BLANKS, " " * len(_BLANKS)), " ", -1), lambda x: x != "").alias("w"),
        F.filter(F.split("t", "\n", -1), lambda x: F.translate(x, " " + _BLANKS, "") != "").alias("l"),
        without(" " + _BLANKS).alias("word_chars"),
        (F.length("t") - without(SYMBOLS)).alias("n_symbols"),
        (F.length("t") - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("n_capitals"))
    # hashes of the three-word windows, by the place of their first word
    three = two.withColumn("n_words", F.size("w")).withColumn(
        "h", F.transform(F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
                         lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))))
    four = three.withColumn("p", F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    # places of the windows that equal a neighbour in sorted order, sorted again by place
    alike = lambda x, i: x["h"].eqNullSafe(F.get("p", i)["h"])
    five = four.withColumn("r", F.array_sort(F.transform(
        F.filter("p", lambda x, i: alike(x, i - 1) | alike(x, i + 1)), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("r", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("r", i + 1), x + 3) - x)),
        F.lit(0), lambda a, x: a + x)
    long = lambda c: c.cast("long")
    return five.select(
        "doc_id", "lang", long(F.col("n_words")).alias("n_words"), long(F.col("word_chars")).alias("word_chars"),
        long(F.col("n_symbols")).alias("n_symbols"), long(F.size("l")).alias("n_lines"),
        long(F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        long(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"), long(F.col("n_capitals")).alias("n_capitals"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial in n and p, exact up to rounding, for k < n."""
    start = F.struct((n * F.log(F.lit(1 - p))).alias("ln"), F.lit(0.0).alias("sum"))
    step = lambda a, i: F.struct(
        (a["ln"] + F.log((n - i) / (i + 1) * F.lit(p / (1 - p)))).alias("ln"), (a["sum"] + F.exp(a["ln"])).alias("sum"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), k.cast("long")), start, step, lambda a: a["sum"])


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(lang, rule, cutoff, n_good, wrong, caught) chosen from the labelled rows of :func:`counts`."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    values = _values()
    labelled = counted.join(known, "doc_id").select("lang", "quality", *[v.alias(r) for r, v in values.items()])
    over = lambda quality, rule, c: F.count(F.when((F.col("quality") == quality) & (F.col(rule) > c), 1))
    sums = [over(q, rule, c).alias(f"{rule}_{k}_{q}")
            for rule in values for k, c in enumerate(CUTOFFS[rule]) for q in (0, 1)]
    strata = scratch(labelled.groupBy("lang").agg(F.count(F.when(F.col("quality") == 1, 1)).alias("n_good"), *sums),
                     "strata")
    tests = max(1, strata.count() * len(values))
    rows = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"{rule}_{k}_1").alias("wrong"),
                 F.col(f"{rule}_{k}_0").alias("caught")) for rule in values for k, c in enumerate(CUTOFFS[rule])]))
    each = strata.select("lang", "n_good", rows.alias("t")).select("lang", "n_good", "t.*")
    limit = risk / len(values)
    possible = each.where((F.col("caught") > 0) & (F.col("wrong") < F.col("n_good") * limit))
    valid = possible.where(binomial_tail(F.col("wrong"), F.col("n_good"), limit) <= delta / tests)
    best = Window.partitionBy("lang", "rule").orderBy(F.desc("caught"), F.desc("cutoff"))
    return valid.withColumn("place", F.row_number().over(best)).where("place = 1").select(
        "lang", "rule", "cutoff", "n_good", "wrong", "caught")


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The columns of :func:`counts` with base_failed, failed (rules whose cutoff the text exceeds) and kept, for each
    row of docs (doc_id, text, lang); labels: doc_id, quality."""
    counted = scratch(counts(docs), "counts")
    chosen = cutoffs(counted, labels, risk, delta).groupBy(F.col("lang").alias("stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts"))
    judged = counted.join(scratch(chosen, "cutoffs"), F.col("lang").eqNullSafe(F.col("stratum")), "left")
    failed = F.array_compact(F.array(*[F.when(v > F.col("cuts")[r], F.lit(r)) for r, v in _values().items()]))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(*counted.columns, base.alias("base_failed"), failed.alias("failed")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed") == 0))
