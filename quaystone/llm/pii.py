"""Personal data: patterns plus a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans. The tagger is trained in numpy from labelled spans (by default those of the
patterns) on at most ``MAX_WINDOWS`` windows of the texts of smallest hash, in one task; its weights are a few
thousand numbers, whatever the input.

A text is cut into windows of ``WINDOW`` characters every ``STRIDE``. Emissions of overlapping windows are
averaged, a window's middle counting most, and one Viterbi pass over the whole stretch of windows decodes them
together, so a span that crosses windows comes out once. A learned span must hold a digit or an at sign, as
every labelled kind does; a window with neither can hold no span and is therefore not decoded.

Defined cases: null and empty texts have no spans; without any labelled span there is no tagger and the spans
are the base ones; rows that repeat a doc_id each get a row; a null doc_id stays null; other columns are ignored;
an empty table gives an empty result. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaystone.llm import bytetext as bt
from quaystone.llm.families import bounded_batches, id_of, key_of, rows_of

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
WINDOW, STRIDE = 96, 48
HIDDEN = 12
CHARS = 130
MAX_WINDOWS = 1500
STEPS, BATCH, RATE = 260, 32, 0.02

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, sorted; each kind leftmost and non-overlapping, failing matches dropped.

    An address starts where the run of local characters before its at sign starts (after the last match), an IP
    only where a run of digits starts: the leftmost match can't start elsewhere, and long runs stay linear.
    """
    found = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            found.append((start, 0, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m[0])) if m.end() - m.start() <= 37 else ""
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def codes(text: str) -> np.ndarray:
    """Character numbers: ASCII, 128 for letters beyond it, 129 for padding."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(points, 128).astype(np.int64)


def tags_of(spans: list[tuple[int, int, int]], n: int) -> np.ndarray:
    tags = np.zeros(n, np.int64)
    for start, kind, end in spans:
        if not tags[start:end].any():
            tags[start:end] = 2 + 2 * kind
            tags[start] = 1 + 2 * kind
    return tags


# ---- the network ----------------------------------------------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_network(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    net = {}
    for side in "fb":
        net[f"x{side}"] = rng.normal(0, 0.3, (CHARS, 4 * HIDDEN))
        net[f"h{side}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        net[f"x{side}"][:, HIDDEN:2 * HIDDEN] += 0.5  # remember by default
    net["out"] = rng.normal(0, 0.3, (2 * HIDDEN, TAGS))
    net["bias"] = np.zeros(TAGS)
    net["move"] = rng.normal(0, 0.1, (TAGS, TAGS))
    return net


def _run(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, keep: bool):
    """Hidden states (time, batch, hidden) of one direction, and what the way back needs."""
    steps, batch = x.shape
    h, c = np.zeros((batch, HIDDEN), wx.dtype), np.zeros((batch, HIDDEN), wx.dtype)
    out, saved = np.empty((steps, batch, HIDDEN), wx.dtype), []
    for t in range(steps):
        z = wx[x[t]] + h @ wh
        gates = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        before = c
        c = f * c + i * g
        tc = np.tanh(c)
        if keep:
            saved.append((h, before, i, f, o, g, tc))
        h = o * tc
        out[t] = h
    return out, saved


def _back(x: np.ndarray, wh: np.ndarray, saved: list, dout: np.ndarray, dx: np.ndarray, dh_: np.ndarray) -> None:
    """Add the gradients of one direction to dx and dh_."""
    batch = x.shape[1]
    dh, dc = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN))
    dz = np.empty((len(saved), batch, 4 * HIDDEN))
    for t in range(len(saved) - 1, -1, -1):
        h, before, i, f, o, g, tc = saved[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - tc * tc)
        z = dz[t]
        z[:, :HIDDEN] = dc * g * i * (1 - i)
        z[:, HIDDEN:2 * HIDDEN] = dc * before * f * (1 - f)
        z[:, 2 * HIDDEN:3 * HIDDEN] = dh * tc * o * (1 - o)
        z[:, 3 * HIDDEN:] = dc * i * (1 - g * g)
        dh_ += h.T @ z
        dc = dc * f
        dh = z @ wh.T
    np.add.at(dx, x.reshape(-1), dz.reshape(-1, 4 * HIDDEN))


def emissions(net: dict[str, np.ndarray], windows: np.ndarray) -> np.ndarray:
    """(windows, time, tags) scores of windows (windows, time) of character numbers."""
    x = windows.T
    forward, _ = _run(x, net["xf"], net["hf"], False)
    backward, _ = _run(x[::-1], net["xb"], net["hb"], False)
    both = np.concatenate([forward, backward[::-1]], 2)
    return (both @ net["out"] + net["bias"]).transpose(1, 0, 2)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


def _crf_gradient(score: np.ndarray, move: np.ndarray, tags: np.ndarray):
    """Loss and its gradients for scores and gold tags (time, batch, ...)."""
    steps, batch, _ = score.shape
    alpha, beta = np.empty_like(score), np.zeros_like(score)
    alpha[0] = score[0]
    for t in range(1, steps):
        alpha[t] = _log_sum(alpha[t - 1][:, :, None] + move, 1) + score[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = _log_sum(move + (score[t + 1] + beta[t + 1])[:, None, :], 2)
    total = _log_sum(alpha[-1], 1)
    dscore = np.exp(alpha + beta - total[None, :, None])
    pair = alpha[:-1][:, :, :, None] + move + (score[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None]
    dmove = np.exp(pair).sum((0, 1))
    t, b = np.indices(tags.shape)
    gold = score[t, b, tags].sum() + move[tags[:-1], tags[1:]].sum()
    dscore[t, b, tags] -= 1
    np.subtract.at(dmove, (tags[:-1], tags[1:]), 1)
    return (total.sum() - gold) / batch, dscore / batch, dmove / batch


def train(windows: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights after ``steps`` batches (Adam) of windows and tags (windows, time)."""
    net, rng = new_network(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    order: list[int] = []
    for step in range(1, steps + 1):
        if len(order) < BATCH:
            order += rng.permutation(len(windows)).tolist()
        now, order = order[:BATCH], order[BATCH:]
        x, y = windows[now].T, tags[now].T
        forward, kept_f = _run(x, net["xf"], net["hf"], True)
        backward, kept_b = _run(x[::-1], net["xb"], net["hb"], True)
        both = np.concatenate([forward, backward[::-1]], 2)
        _, dscore, dmove = _crf_gradient(both @ net["out"] + net["bias"], net["move"], y)
        flat = dscore.reshape(-1, TAGS)
        grad = {k: np.zeros_like(v) for k, v in net.items()}
        grad["out"], grad["bias"], grad["move"] = both.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(0), dmove
        dboth = dscore @ net["out"].T
        _back(x, net["hf"], kept_f, dboth[:, :, :HIDDEN], grad["xf"], grad["hf"])
        _back(x[::-1], net["hb"], kept_b, dboth[::-1, :, HIDDEN:], grad["xb"], grad["hb"])
        size = np.sqrt(sum((g * g).sum() for g in grad.values()))
        rate = RATE * (1 - step / (steps + 1))
        for k, g in grad.items():
            g = g * min(1.0, 5.0 / (size + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            net[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in net.items()}


def viterbi(score: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best tags of scores (time, tags)."""
    back = np.empty(score.shape, np.int64)
    best = score[0]
    for t in range(1, len(score)):
        through = best[:, None] + move
        back[t] = through.argmax(0)
        best = through.max(0) + score[t]
    out = np.empty(len(score), np.int64)
    out[-1] = best.argmax()
    for t in range(len(score) - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out


# ---- windows of texts -----------------------------------------------------------------------------------------------

def _marked(x: np.ndarray) -> np.ndarray:
    return ((x >= 48) & (x <= 57)) | (x == 64)


def window_starts(x: np.ndarray) -> np.ndarray:
    """Starts of the windows of a text that hold a digit or an at sign."""
    sums = np.concatenate([[0], np.cumsum(_marked(x))])
    starts = np.arange(0, max(1, len(x) - STRIDE), STRIDE)
    return starts[sums[np.minimum(starts + WINDOW, len(x))] > sums[starts]]


def windows_at(x: np.ndarray, starts: np.ndarray, fill: int = CHARS - 1) -> np.ndarray:
    padded = np.concatenate([x, np.full(WINDOW, fill, x.dtype)])
    return padded[starts[:, None] + np.arange(WINDOW)]


_WEIGHT = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]).astype(np.float32) + 1


def learned_spans(x: np.ndarray, starts: np.ndarray, score: np.ndarray, move: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) decoded from the windows' emissions, one Viterbi pass for each stretch of windows."""
    found = []
    cuts = np.flatnonzero(np.diff(starts) > STRIDE) + 1
    for part in np.split(np.arange(len(starts)), cuts):
        low, high = starts[part[0]], min(starts[part[-1]] + WINDOW, len(x))
        total, weight = np.zeros((high - low, TAGS), np.float32), np.zeros(high - low, np.float32)
        for k in part:
            at, n = starts[k] - low, min(WINDOW, high - starts[k])
            total[at:at + n] += score[k, :n] * _WEIGHT[:n, None]
            weight[at:at + n] += _WEIGHT[:n]
        tags = viterbi(total / weight[:, None], move)
        kind = (tags + 1) // 2  # 0 outside
        begin = np.flatnonzero((kind > 0) & ((tags % 2 == 1) | (np.concatenate([[0], kind[:-1]]) != kind)))
        for b in begin:
            e = b + 1
            while e < len(tags) and kind[e] == kind[b] and tags[e] % 2 == 0:
                e += 1
            if _marked(x[low + b:low + e]).any():
                found.append((int(low + b), int(kind[b]) - 1, int(low + e)))
    return found


def fit(docs: DataFrame, max_windows: int = MAX_WINDOWS) -> dict[str, np.ndarray] | None:
    """Weights trained on windows of docs (doc_id, text) labelled by the patterns; None without a labelled span.

    A window is kept by the smallest hash of its text's id, up to ``max_windows`` with a span and a third as many
    without.
    """
    bounded_batches(docs.sparkSession)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"rank": [], "spans": [], "x": [], "y": []}
            for r, text in _with_marks(batch.column(1)):
                x, spans = codes(text), base_spans(text)
                starts = window_starts(x)
                if not len(starts):
                    continue
                y = tags_of(spans, len(x))
                rank = int(bt.mix(np.array([batch.column(0)[r].as_py()], np.int64).view(np.uint64))[0] >> np.uint64(1))
                # a few windows of a text, spread over it
                for s, wx, wy in zip(starts.tolist(), windows_at(x, starts), windows_at(y, starts, 0)):
                    out["rank"].append((rank + s * 0x9E3779B97F4A7C1) % (1 << 63))
                    out["spans"].append(bool(wy.any()))
                    out["x"].append(wx.astype(np.uint8).tobytes())
                    out["y"].append(wy.astype(np.uint8).tobytes())
            if out["rank"]:
                yield rows_of(rank=pa.array(out["rank"], pa.int64()), spans=pa.array(out["spans"]),
                              x=pa.array(out["x"], pa.binary()), y=pa.array(out["y"], pa.binary()))

    rows = docs.select(key_of().alias("doc"), F.col("text").cast("string").alias("text")).mapInArrow(
        label, "rank long, spans boolean, x binary, y binary")
    chosen = rows.where("spans").orderBy("rank", "x").limit(max_windows).unionByName(
        rows.where("not spans").orderBy("rank", "x").limit(max_windows // 3))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not got:
            return
        table = pa.concat_tables(got).sort_by([("rank", "ascending"), ("x", "ascending")])
        x, y = (np.array([np.frombuffer(v, np.uint8) for v in table[c].to_pylist()]).astype(np.int64) for c in "xy")
        if y.any():
            for name, value in train(x, y).items():
                yield rows_of(name=[name], rows=[value.shape[0]], value=pa.array([value.tobytes()], pa.binary()))

    model = chosen.coalesce(1).mapInArrow(learn, "name string, rows long, value binary").collect()
    return {r["name"]: _shaped(np.frombuffer(r["value"], np.float32), r["rows"]) for r in model} or None


def _shaped(value: np.ndarray, rows: int) -> np.ndarray:
    return value.reshape(rows, -1) if len(value) > rows else value


def _with_marks(column: pa.Array) -> Iterator[tuple[int, str]]:
    """(row, text) of the texts with a digit or an at sign."""
    for low, high, data, offsets in bt.chunks(column):
        sums = np.concatenate([[0], np.cumsum(_marked(data))])
        for r in np.flatnonzero(sums[offsets[1:]] > sums[offsets[:-1]]):
            yield low + int(r), data[offsets[r]:offsets[r + 1]].tobytes().decode()


def find_pii(docs: DataFrame, net: dict[str, np.ndarray] | None) -> DataFrame:
    """(doc_id, spans) for each row of docs (doc_id, text): spans is an array of (start, end, kind, base), sorted by
    start and kind; base spans stay whole, learned spans come besides."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(net)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[] for _ in range(batch.num_rows)]
            waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
            held = 0
            for r, text in _with_marks(batch.column(1)):
                base = base_spans(text)
                found[r] = [(s, e, k, True) for s, k, e in base]
                if shared.value is not None:
                    x = codes(text)
                    starts = window_starts(x)
                    waiting.append((r, x, starts))
                    held += len(starts)
                    if held > 2048:
                        _decode(shared.value, waiting, found)
                        waiting, held = [], 0
            if waiting:
                _decode(shared.value, waiting, found)
            rows = [[{"start": s, "end": e, "kind": KINDS[k], "base": b} for s, e, k, b in
                     sorted(f, key=lambda v: (v[0], v[2], v[1]))] for f in found]
            yield rows_of(doc=batch.column(0), spans=pa.array(rows, _SPANS))

    rows = docs.select(key_of().alias("doc"), F.col("text").cast("string").alias("text"))
    kind = "array<struct<start:bigint,end:bigint,kind:string,base:boolean>>"
    return rows.mapInArrow(work, f"doc long, spans {kind}").select(id_of("doc").alias("doc_id"), "spans")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())]))


def _decode(net: dict[str, np.ndarray], waiting: list, found: list[list]) -> None:
    windows = [(r, x, s, windows_at(x, s)) for r, x, s in waiting if len(s)]
    if not windows:
        return
    every = np.concatenate([w for *_, w in windows])
    score = np.concatenate([emissions(net, every[k:k + 512]) for k in range(0, len(every), 512)])
    at = 0
    for r, x, starts, w in windows:
        known = {v[:3] for v in found[r]}
        found[r] += [(s, e, k, False) for s, k, e in learned_spans(x, starts, score[at:at + len(w)], net["move"])
                     if (s, e, k) not in known]
        at += len(w)
