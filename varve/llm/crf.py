"""Quality classifier: a linear-chain conditional random field over the lines of a text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varve.llm.common import chunks, map_texts, text_of
from varve.session import materialize

# Labelled documents the model learns from, and lines of these, at most; those of least hash are taken.
SAMPLE_ROWS, SAMPLE_LINES = 4000, 200_000
# Steps of the fit, its step size, and the weight of the penalty on large parameters.
STEPS, RATE, PENALTY = 250, 0.05, 1e-3
# A text counts as good from this score on.
GOOD_FROM = 0.3

_UPPER, _LOWER, _DIGIT, _SPACE, _SIGN, _MARK, _BAR, _BANG, _WIDE = range(9)


def _classes() -> np.ndarray:
    table = np.full(256, _MARK, np.int64)
    table[ord("A") : ord("Z") + 1] = _UPPER
    table[ord("a") : ord("z") + 1] = _LOWER
    table[ord("0") : ord("9") + 1] = _DIGIT
    table[[9, 10, 11, 12, 13, 32]] = _SPACE
    table[[ord(c) for c in "#*$%&<>@^~_=+{}[]\\"]] = _SIGN
    table[ord("|")] = _BAR
    table[ord("!")] = _BANG
    table[128:] = _WIDE
    return table


_CLASS = _classes()
CLASSES = 9
OWN = CLASSES + 7
FEATURES = 3 * OWN + 1


def lines_of(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray]:
    """The lines of each text, and how many; an empty text has one empty line."""
    lines = [t.encode().split(b"\n") for t in texts]
    return lines, np.array([len(x) for x in lines], np.int64)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines x FEATURES, bytes of each line, lines of each text).

    A line's own features are the shares of its kinds of bytes, its length, words and their
    variety, and whether it repeats an earlier line. To them come those of the line before and
    the line after, zero at the ends of a text.
    """
    lists, sizes = lines_of(texts)
    flat = [line for lines in lists for line in lines]
    n = len(flat)
    length = np.fromiter(map(len, flat), np.int64, n)
    raw = np.frombuffer(b"".join(flat), np.uint8)
    owner = np.repeat(np.arange(n), length)
    counts = np.bincount(owner * CLASSES + _CLASS[raw], minlength=n * CLASSES).reshape(n, CLASSES)
    own = np.zeros((n, OWN), np.float32)
    own[:, :CLASSES] = counts / np.maximum(length, 1)[:, None]
    at = 0
    words = np.zeros(n, np.float32)
    for lines in lists:
        seen: set[bytes] = set()
        for line in lines:
            found = line.split()
            k = len(found)
            if k:
                words[at] = k
                kinds = len(set(found))
                own[at, CLASSES] = 1 - kinds / k
                own[at, CLASSES + 1] = sum(map(bytes.__eq__, found, found[1:])) / k
                own[at, CLASSES + 2] = line in seen
                seen.add(line)
            at += 1
    own[:, CLASSES + 3] = np.log1p(length) / 8
    own[:, CLASSES + 4] = np.log1p(words) / 6
    own[:, CLASSES + 5] = np.minimum(length / np.maximum(words, 1), 40) / 20
    own[:, CLASSES + 6] = words == 0
    starts = np.cumsum(sizes) - sizes
    before = np.zeros_like(own)
    before[1:] = own[:-1]
    before[starts] = 0
    after = np.zeros_like(own)
    after[:-1] = own[1:]
    after[starts[1:] - 1] = 0
    return np.concatenate([own, before, after, np.ones((n, 1), np.float32)], axis=1), length, sizes


@dataclass
class Crf:
    """Weights of the good state over the bad one, transitions, and the calibration of a text."""

    emit: np.ndarray  # FEATURES
    move: np.ndarray  # 2 x 2, from and to
    start: np.ndarray  # 2
    scale: float = 1.0
    shift: float = 0.0
    rate: float = 0.5  # share of good texts among those learned from


def _chains(sizes: np.ndarray):
    """Texts by falling number of lines, with the rows of their lines at each position."""
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    ranked = sizes[order]
    return order, starts, ranked


def forward_backward(model: Crf, scores: np.ndarray, sizes: np.ndarray):
    """Marginals (lines x 2), expected transitions (2 x 2) and log partition of each text.

    All texts walk in step, those with fewer lines drop out; everything stays in logarithms.
    """
    order, starts, ranked = _chains(sizes)
    local = np.stack([np.zeros(len(scores)), scores], axis=1)
    alpha, beta = np.zeros_like(local), np.zeros_like(local)
    active = [int(k) for k in np.searchsorted(-ranked, -np.arange(1, int(ranked[0]) + 1), side="right")] if len(ranked) else []
    for t, k in enumerate(active):
        rows = starts[:k] + t
        if t == 0:
            alpha[rows] = local[rows] + model.start
        else:
            alpha[rows] = local[rows] + np.logaddexp(alpha[rows - 1, :1] + model.move[0], alpha[rows - 1, 1:] + model.move[1])
    for t in range(len(active) - 2, -1, -1):
        rows = starts[: active[t + 1]] + t
        ahead = beta[rows + 1] + local[rows + 1]
        beta[rows] = np.logaddexp(ahead[:, :1] + model.move[:, 0], ahead[:, 1:] + model.move[:, 1])
    last = np.cumsum(sizes) - 1
    total = np.logaddexp(alpha[last, 0], alpha[last, 1])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    marginal = np.exp(alpha + beta - total[owner][:, None])
    inner = np.ones(len(scores), bool)
    inner[last] = False
    rows = np.flatnonzero(inner)
    ahead = beta[rows + 1] + local[rows + 1]
    pair = np.exp(alpha[rows, :, None] + model.move[None] + ahead[:, None, :] - total[owner[rows]][:, None, None])
    return marginal, pair, total


def document_score(model: Crf, marginal: np.ndarray, length: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Marginals of the good state averaged by the lines' lengths, then calibrated to 0..1."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    weight = length + 1.0
    share = np.bincount(owner, weight * marginal[:, 1], len(sizes)) / np.bincount(owner, weight, len(sizes))
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return 1 / (1 + np.exp(-(model.scale * np.log(share / (1 - share)) + model.shift)))


def fit(x: np.ndarray, length: np.ndarray, sizes: np.ndarray, good: np.ndarray) -> Crf:
    """Maximise the likelihood of the texts' labels, which all lines of a text share, by Adam.

    A text counts once, however many lines it has. Then a text's score is calibrated on the same
    texts. Without texts of both labels the score is the share of good ones.
    """
    model = Crf(np.zeros(x.shape[1]), np.zeros((2, 2)), np.zeros(2))
    if not len(sizes):
        return model
    model.rate = float(good.mean())
    if model.rate in (0.0, 1.0):
        return model
    owner = np.repeat(np.arange(len(sizes)), sizes)
    label = good[owner].astype(np.int64)
    weight = 1 / np.sqrt(sizes)[owner]
    last = np.cumsum(sizes) - 1
    inner = np.ones(len(x), bool)
    inner[last] = False
    first = last - sizes + 1
    seen = np.zeros((len(x), 2, 2))
    seen[np.arange(len(x)), label, label] = 1
    values = [model.emit, model.move, model.start]
    steps = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    for turn in range(1, STEPS + 1):
        marginal, pair, _ = forward_backward(model, x @ model.emit, sizes)
        grads = [
            x.T @ (weight * (label - marginal[:, 1])) / len(sizes) - PENALTY * model.emit,
            ((seen[inner] - pair) * weight[inner][:, None, None]).sum(axis=0) / len(sizes) - PENALTY * model.move,
            (np.eye(2)[label[first]] - marginal[first]).mean(axis=0) - PENALTY * model.start,
        ]
        for value, grad, (mean, square) in zip(values, grads, steps):
            mean += 0.1 * (grad - mean)
            square += 0.01 * (grad * grad - square)
            value += RATE * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
    marginal, _, _ = forward_backward(model, x @ model.emit, sizes)
    raw = document_score(model, marginal, length, sizes)
    z = np.log(np.clip(raw, 1e-6, 1 - 1e-6) / (1 - np.clip(raw, 1e-6, 1 - 1e-6)))
    for _ in range(50):  # Newton steps of a penalised logistic fit
        p = 1 / (1 + np.exp(-(model.scale * z + model.shift)))
        design = np.stack([z, np.ones_like(z)], axis=1)
        slope = design.T @ (good - p) - 1e-2 * np.array([model.scale, model.shift])
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        model.scale, model.shift = np.array([model.scale, model.shift]) + np.linalg.solve(curve, slope)
    return model


def _drawn(labels: DataFrame, id_column: str, label: str) -> DataFrame:
    """(id, label, order) of at most ``SAMPLE_ROWS`` labelled ids, those of least hash.

    Rows of one id count once, with the least label. Of a large table only the rows whose hash is
    below about twice the bound sought are ordered; if these should be too few, all are.
    """
    named = labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    once = named.where("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.min("label").alias("label"))
    once = once.select("*", F.xxhash64("id").alias("order"))
    count = labels.count()
    share = min(1.0, 2 * SAMPLE_ROWS / max(count, 1))
    below = once.where(F.col("order") < F.lit(int((2 * share - 1) * (1 << 62)) * 2)) if share < 1 else once
    drawn = below.orderBy("order", "id").limit(SAMPLE_ROWS)
    if share < 1 and drawn.count() < SAMPLE_ROWS:
        return once.orderBy("order", "id").limit(SAMPLE_ROWS)
    return drawn


def training_texts(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", label: str = "quality", text: str = "text") -> DataFrame:
    """(label, body) of the rows that the model learns from.

    At most ``SAMPLE_ROWS`` ids are drawn by their hash from the labels alone; their texts are found by
    a broadcast of these few ids, so texts are not shuffled. Rows of one id count once, with the text of
    least hash. Taken in the order of their hash, texts together have at most ``SAMPLE_LINES`` lines;
    one with more than a tenth of that is not learned from.
    """
    drawn = F.broadcast(materialize(_drawn(labels, id_column, label), "drawn"))
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), text_of(text).alias("body"))
    least = F.min(F.struct(F.xxhash64("body").alias("hash"), "body")).alias("least")
    found = texts.join(drawn, "id").groupBy("id", "label", "order").agg(least)
    lines = F.length("body") - F.length(F.replace("body", F.lit("\n"))) + 1
    found = found.select("id", "label", "order", F.col("least.body").alias("body")).withColumn("lines", lines)
    found = materialize(found.where(F.col("lines") <= SAMPLE_LINES // 10), "training")
    # No more rows than were drawn.
    so_far = F.sum("lines").over(Window.orderBy("order", "id").rowsBetween(Window.unboundedPreceding, 0))
    fits = found.select("id", so_far.alias("so_far"), "order", "lines").where(F.col("so_far") <= SAMPLE_LINES).select("id")
    return found.join(F.broadcast(fits), "id").orderBy("order", "id").select("label", "body")


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", label: str = "quality", text: str = "text") -> Crf:
    """Fit on a bounded sample, by :func:`training_texts`.

    The workers turn whole texts into features, of which the driver gets the sample's: at most
    ``SAMPLE_LINES`` rows of ``FEATURES`` numbers. Null ids and labels teach nothing.
    """
    source = training_texts(docs, labels, id_column, label, text)

    def run(batches):
        for piece, texts in chunks(batches, "body"):
            x, length, sizes = features(texts)
            starts = np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[a : a + n].astype(np.float32).tobytes() for a, n in zip(starts, sizes)], pa.binary()),
                    pa.array([length[a : a + n].tobytes() for a, n in zip(starts, sizes)], pa.binary()),
                    piece.column(0),
                ],
                names=["x", "length", "label"],
            )

    sample = source.mapInArrow(run, "x binary, length binary, label int").toPandas()
    if not len(sample):
        return fit(np.zeros((0, FEATURES)), np.zeros(0), np.zeros(0, np.int64), np.zeros(0))
    length = [np.frombuffer(b, np.int64) for b in sample["length"]]
    x = np.frombuffer(b"".join(sample["x"]), np.float32).reshape(-1, FEATURES).astype(np.float64)
    sizes = np.array([len(v) for v in length])
    return fit(x, np.concatenate(length), sizes, (sample["label"] > 0).to_numpy(np.float64))


def score(docs: DataFrame, keep: list[str], model: Crf, text: str = "text") -> DataFrame:
    """``keep``, ``score`` (0 to 1, higher: good likelier) and ``predicted`` of every text.

    The score is the average of its lines' marginals, weighted by length, and calibrated. A null or
    empty text is one empty line and gets a score like any other; repeated rows score alike. Other
    columns are never looked at, whatever their names. An empty table gives none. One pass without
    a shuffle; a piece of texts is held at a time.
    """

    def body(texts):
        if model.rate in (0.0, 1.0):
            scores = np.full(len(texts), model.rate)
        else:
            x, length, sizes = features(texts)
            marginal, _, _ = forward_backward(model, x @ model.emit, sizes)
            scores = document_score(model, marginal, length, sizes)
        return [scores, (scores >= GOOD_FROM).astype(np.int32)]

    return map_texts(docs, keep, text_of(text), body, "score double, predicted int")
