"""Quality classifier: logistic regression on hashed word n-grams, trained by follow the regularised leader.

Tokens are runs of word characters (letters, digits, all beyond ASCII) and runs of other visible characters, so
"idea!!" is two tokens. Features are the tokens and pairs of neighbouring tokens, hashed to ``BUCKETS`` (a token
with itself is one feature for all tokens, so stuttering shows on words never seen); a feature's value is its share of the text's features, so a text's length isn't an input. Nothing but the text is
an input of a score.

Training takes at most ``MAX_TRAINING`` labelled rows, those of smallest hash of doc_id, balanced by class
weights, and runs the updates one by one in one task; the non-zero weights (``BUCKETS`` at most) are broadcast.
Scoring is a sparse dot product: a gather of weights and a sum per text, for whole batches.

Defined cases: null, empty and blank texts have no features and get the score of the bias; without labelled rows
of both classes every score is 0.5 (kept); rows that repeat a doc_id each get a row; null labels are ignored,
as are other columns; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.llm import bytetext as bt
from quaystone.llm.families import bounded_batches, id_of, key_of, rows_of

BUCKETS = 1 << 18
#: Most labelled rows that training reads.
MAX_TRAINING = 4000
EPOCHS = 4
#: Learning rate and its delay, L1 and L2 of the updates.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.5, 0.0
#: Scale of the shares, so that the penalties act alike on texts of any length.
SCALE = 10.0

_KIND = np.ones(256, np.int8)  # 0 blank, 1 word, 2 other
_KIND[:33] = 0
_KIND[127] = 0
for _low, _high in ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)):
    _KIND[_low:_high + 1] = 2


#: The pair of a token with itself is one feature, whatever the token.
_REPEAT = bt.mix(np.uint64(1))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every token and every pair of neighbours of a chunk, by row."""
    kind = _KIND[data]
    n = len(kind)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    change = np.ones(n + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    start = np.flatnonzero(change[:-1] & (kind > 0))
    cuts = np.flatnonzero(change)
    end = cuts[np.searchsorted(cuts, start) + 1]
    row = bt.row_of(offsets, start)
    token = bt.Rolling(data).of(start, end)
    with np.errstate(over="ignore"):
        pair = bt.mix(token[:-1] * np.uint64(0x9E3779B97F4A7C15) + token[1:])
    pair[token[:-1] == token[1:]] = _REPEAT
    inside = row[1:] == row[:-1]
    rows = np.concatenate([row, row[:-1][inside]])
    buckets = (np.concatenate([token, pair[inside]]) % np.uint64(BUCKETS)).astype(np.int64)
    order = np.argsort(rows, kind="stable")
    return rows[order], buckets[order]


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """(weights, bias) by follow the regularised leader, one row (buckets, shares, label) after the other."""
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    bias = bias_n = 0.0
    counts = [max(1, sum(r[2] == c for r in rows)) for c in (0, 1)]
    weight_of = [len(rows) / (2 * c) for c in counts]

    def weights(at):
        return np.where(np.abs(z[at]) <= L1, 0.0,
                        -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for bucket, share, label in rows:
            w = weights(bucket)
            p = 1 / (1 + np.exp(-np.clip(w @ share + bias, -35, 35)))
            error = (p - label) * weight_of[label]
            g = error * share
            sigma = (np.sqrt(n[bucket] + g * g) - np.sqrt(n[bucket])) / ALPHA
            z[bucket] += g - sigma * w
            n[bucket] += g * g
            bias_n += error * error
            bias -= 0.1 * error / (1 + np.sqrt(bias_n))
    return weights(np.arange(BUCKETS)), bias


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING) -> tuple[np.ndarray, np.ndarray, float] | None:
    """(buckets, weights, bias), or None without rows of both classes. docs: doc_id, text; labels: doc_id, quality."""
    bounded_batches(docs.sparkSession)
    chosen = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc")).agg(F.min("quality").cast("int").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc"), "doc").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc").select("doc", "quality", "text")  # max_rows pairs of numbers

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            doc, quality = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for low, high, data, offsets in bt.chunks(batch.column(2)):
                row, bucket = features(data, offsets)
                firsts = np.searchsorted(row, np.arange(high - low + 1))
                for r in range(high - low):
                    used, times = np.unique(bucket[firsts[r]:firsts[r + 1]], return_counts=True)
                    held.append((int(doc[low + r]), used, SCALE * times / max(1, times.sum()), int(quality[low + r])))
        held.sort(key=lambda x: (bt.mix(np.array([x[0]], np.int64).view(np.uint64))[0], len(x[1])))
        if len({x[3] for x in held}) == 2:
            weight, bias = train([x[1:] for x in held])
            used = np.flatnonzero(weight)
            yield rows_of(bucket=np.concatenate([[-1], used]), weight=np.concatenate([[bias], weight[used]]))

    # max_rows rows meet in one task; the scan before it keeps its tasks
    model = rows.repartition(1).mapInArrow(learn, "bucket long, weight double").toArrow()
    if not model.num_rows:
        return None
    bucket, weight = model["bucket"].to_numpy(), model["weight"].to_numpy()
    return bucket[bucket >= 0], weight[bucket >= 0], float(weight[bucket < 0][0])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float] | None, row: str | None = None) -> DataFrame:
    """(doc_id, score) for each row of docs (doc_id, text), score in 0 to 1."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared: Broadcast = spark.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, bias = np.zeros(BUCKETS), 0.0
        if shared.value is not None:
            dense[shared.value[0]] = shared.value[1]
            bias = shared.value[2]
        for batch in batches:
            for low, high, data, offsets in bt.chunks(batch.column(1)):
                row, bucket = features(data, offsets)
                total = np.bincount(row, weights=dense[bucket], minlength=high - low)
                count = np.maximum(np.bincount(row, minlength=high - low), 1)
                value = np.clip(SCALE * total / count + bias, -35, 35)
                yield rows_of(doc=batch.column(0).slice(low, high - low), score=1 / (1 + np.exp(-value)))

    rows = docs.select(key_of().alias("doc"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc long, score double").select(id_of("doc").alias("doc_id"), "score")


def keep_good(docs: DataFrame, model, least: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, that score ``least`` or more."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scored = spark.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, bias = np.zeros(BUCKETS), 0.0
        if scored.value is not None:
            dense[scored.value[0]] = scored.value[1]
            bias = scored.value[2]
        at = names.index("text")
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for low, high, data, offsets in bt.chunks(batch.column(at).cast(pa.large_string()), bt.CHUNK_BYTES // 2):
                row, bucket = features(data, offsets)
                total = np.bincount(row, weights=dense[bucket], minlength=high - low)
                count = np.maximum(np.bincount(row, minlength=high - low), 1)
                value = SCALE * total / count + bias
                keep[low:high] = 1 / (1 + np.exp(-np.clip(value, -35, 35))) >= least
            yield batch.filter(pa.array(keep))

    names = docs.columns
    return docs.mapInArrow(work, docs.schema)
