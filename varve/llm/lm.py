"""LM scoring: a log-bilinear neural model, trained by noise-contrastive estimation."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.llm.common import chunks, parts_for
from varve.session import fresh_dir, materialize

# Words with a vector of their own. All others share the class "rare", whose words differ by count.
OWN_WORDS = 1023
# Most frequent words whose counts every task gets; a fixed bound, as for the own words.
SENT_WORDS = 1 << 16
# Size of a word's vector, words of context.
DIM, CONTEXT = 16, 2
# Tokens in a step of the training, noise words of a step, step size.
BATCH, NOISE, RATE = 8192, 96, 0.15
# Tokens that one learner takes in, about, before the learners' models are averaged and the next round begins.
# Only so many learn side by side that there are this many rounds: averages of shallow models score worse.
# Both follow the number of tokens alone, so that a cluster of any size gives the same model.
ROUND_TOKENS, LEAST_ROUNDS = 1 << 20, 8
# Different words that a task counts before it hands its counts on.
HELD_WORDS = 400_000
# Words without a vector whose class a task remembers.
RARE_HELD = 200_000
# Contexts whose probabilities are worked out at once.
TOGETHER = 1024
# Characters of text whose contexts are looked at together: repeated ones are worked out once.
SCORED_CHARS = 1 << 22

END = b" "  # white space is no part of a word, so no word is the end
SEED = 20_240_202

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; bytes.split() has just that white space."""
    return text.encode().translate(_LOWER).split()


def tokens_of(texts: list[str]) -> tuple[list[bytes], list[int]]:
    """Words of all texts, an end after each text, and the tokens of each text."""
    flat, sizes = [], []
    for text in texts:
        words = words_of(text)
        flat += words
        flat.append(END)
        sizes.append(len(words) + 1)
    return flat, sizes


def word_key(word: bytes) -> int:
    """64-bit fingerprint of a word, signed as Spark's long."""
    from xxhash import xxh3_64_intdigest

    key = xxh3_64_intdigest(word)
    return key - (1 << 64) if key >> 63 else key


@dataclass
class Model:
    """Vectors of target and context words, context weights by place, and biases."""

    target: np.ndarray  # classes x DIM
    context: np.ndarray  # classes + 1 (before the text) x DIM
    places: np.ndarray  # CONTEXT x DIM
    bias: np.ndarray  # classes

    def pack(self) -> bytes:
        return np.concatenate([x.astype(np.float32).ravel() for x in (self.target, self.context, self.places, self.bias)]).tobytes()

    @staticmethod
    def unpack(raw, classes: int) -> Model:
        flat = np.frombuffer(raw, np.float32) if isinstance(raw, bytes) else np.asarray(raw, np.float32)
        shapes = [(classes, DIM), (classes + 1, DIM), (CONTEXT, DIM), (classes,)]
        out, at = [], 0
        for shape in shapes:
            size = int(np.prod(shape))
            out.append(flat[at : at + size].reshape(shape).copy())
            at += size
        return Model(*out)


def start_model(shares: np.ndarray) -> Model:
    """Small random vectors; the bias of a class is the logarithm of its share."""
    rng = np.random.default_rng(SEED)
    classes = len(shares)
    return Model(
        rng.normal(0, 0.1, (classes, DIM)).astype(np.float32),
        rng.normal(0, 0.1, (classes + 1, DIM)).astype(np.float32),
        np.ones((CONTEXT, DIM), np.float32),
        np.log(np.maximum(shares, 1e-12)).astype(np.float32),
    )


def contexts(ids: np.ndarray, starts: np.ndarray, before: int) -> np.ndarray:
    """(tokens, CONTEXT) ids of the words before each token of texts that start at ``starts``."""
    out = np.full((len(ids), CONTEXT), before, np.int32)
    offset = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    for k in range(1, CONTEXT + 1):
        out[k:, k - 1] = np.where(offset[k:] >= k, ids[:-k] if k else ids, before)
    return out


def _scatter(rows: np.ndarray, ids: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows of each id."""
    # Short integers are sorted by their digits.
    order = np.argsort(ids.astype(np.uint16) if size <= 1 << 16 else ids, kind="stable")
    ranked = ids[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    out = np.zeros((size, *rows.shape[1:]), np.float32)
    out[ranked[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


class Trainer:
    """Noise-contrastive estimation by AdaGrad steps over batches of tokens."""

    def __init__(self, model: Model, noise: np.ndarray, squares: Model, seed: int = SEED):
        self.model = model
        self.noise = noise
        self.draws = np.cumsum(noise)
        self.log_noise = np.log(np.maximum(noise, 1e-12)).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.squares = squares
        self.space = np.empty((BATCH, NOISE), np.float32)

    def step(self, ids: np.ndarray, context: np.ndarray) -> None:
        """One batch: tell each token from NOISE words that the whole batch shares."""
        m = self.model
        n = len(ids)
        vectors = [m.context[context[:, k]] for k in range(CONTEXT)]
        query = sum(v * m.places[k] for k, v in enumerate(vectors))
        drawn = np.minimum(np.searchsorted(self.draws, self.rng.random(NOISE) * self.draws[-1]), len(self.noise) - 1)
        # The chance that a word is data and not noise: its score against NOISE times its noise share.
        extra = np.float32(np.log(NOISE))
        good = np.einsum("nd,nd->n", query, m.target[ids]) + m.bias[ids] - self.log_noise[ids] - extra
        g_good = 1 / (1 + np.exp(np.clip(good, -30, 30)))
        g_bad = np.matmul(query, m.target[drawn].T, out=self.space[:n])
        g_bad += m.bias[drawn] - self.log_noise[drawn] - extra
        np.clip(g_bad, -30, 30, out=g_bad)
        # -1 / (1 + exp(-x)), in place: the matrix is the largest of a step.
        np.negative(g_bad, out=g_bad)
        np.exp(g_bad, out=g_bad)
        g_bad += 1
        np.divide(-1, g_bad, out=g_bad)
        d_query = g_good[:, None] * m.target[ids] + g_bad @ m.target[drawn]
        d_target = _scatter(g_good[:, None] * query, ids, len(m.target))
        np.add.at(d_target, drawn, g_bad.T @ query)
        d_bias = _scatter(g_good, ids, len(m.bias))
        np.add.at(d_bias, drawn, g_bad.sum(axis=0))
        d_context = sum(_scatter(d_query * m.places[k], context[:, k], len(m.context)) for k in range(CONTEXT))
        d_places = np.stack([(d_query * v).sum(axis=0) for v in vectors])
        q = self.squares
        for value, grad, square in zip(
            (m.target, m.context, m.places, m.bias),
            (d_target, d_context, d_places, d_bias),
            (q.target, q.context, q.places, q.bias),
        ):
            grad /= n
            square += grad * grad
            value += (RATE * grad / np.sqrt(square)).astype(np.float32)


def log10_probabilities(model: Model, ids: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Normalised log10 probability of each token's class after its context.

    The sum over all classes is worked out once for each different context, by matrix products
    over blocks of contexts.
    """
    base = len(model.context)
    keys = context[:, 0].astype(np.int64)
    for k in range(1, CONTEXT):
        keys = keys * base + context[:, k]
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    query = sum(model.context[context[first, k]] * model.places[k] for k in range(CONTEXT))
    norm = np.empty(len(first), np.float64)
    turned, ones = np.ascontiguousarray(model.target.T), np.ones(len(model.target), np.float32)
    for at in range(0, len(first), TOGETHER):
        logits = query[at : at + TOGETHER] @ turned
        logits += model.bias
        top = logits.max(axis=1)
        logits -= top[:, None]
        np.exp(logits, out=logits)
        norm[at : at + TOGETHER] = top + np.log((logits @ ones).astype(np.float64))
    own = np.einsum("nd,nd->n", query[which], model.target[ids]).astype(np.float64) + model.bias[ids]
    return (own - norm[which]) / np.log(10)


@dataclass
class Vocabulary:
    """What every task knows of the counts: all of bounded size.

    ``count`` has the SENT_WORDS most frequent words by fingerprint. The first OWN_WORDS of them,
    and the end, have classes of their own; class ``rare`` holds all other words.
    """

    count: dict[int, int]
    own: dict[int, int]
    tokens: int
    types: int
    rare_tokens: int
    rare_types: int
    discount: float
    shares: np.ndarray

    @property
    def rare(self) -> int:
        return len(self.shares) - 1

    def base(self, count):
        return np.log10((np.asarray(count, np.float64) + 1) / (self.tokens + self.types + 1))

    def within_rare(self, count):
        """log10 share of a word in the class of rare ones, by its count; 0 stands for all unseen ones.

        Absolute discounting: every known word gives up ``discount`` of its count to the unseen.
        """
        count = np.asarray(count, np.float64)
        if not self.rare_tokens:
            return np.where(count > 0, -np.inf, 0.0)
        unseen = self.discount * self.rare_types / self.rare_tokens
        return np.log10(np.where(count > 0, (count - self.discount) / self.rare_tokens, unseen))


def count_words(docs: DataFrame) -> DataFrame:
    """(key, n): how often each word, by fingerprint, and the end occur in the texts ``body``.

    Tasks add up what they read first, in a table of bounded size, then the counts are summed.
    """

    def run(batches):
        counts: dict[bytes, int] = {}
        ends = 0

        def out():
            keys = [word_key(w) for w in counts] + [word_key(END)] * bool(ends)
            n = [*counts.values()] + [ends] * bool(ends)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])

        for _, texts in chunks(batches, "body"):
            for text in texts:
                for word in words_of(text):
                    counts[word] = counts.get(word, 0) + 1
            ends += len(texts)
            if len(counts) > HELD_WORDS:
                yield out()
                counts.clear()
                ends = 0
        yield out()

    return docs.select("body").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Gather totals and the most frequent words, ties by fingerprint; both of bounded size."""
    end = word_key(END)
    sums = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("types")).first()
    top = counts.orderBy(F.desc("n"), "key").limit(SENT_WORDS).toPandas()
    ends = counts.where(F.col("key") == end).select("n").first()
    pairs = [(k, n) for k, n in zip(top["key"].tolist(), top["n"].tolist()) if k != end]
    own = {k: c for c, (k, _) in enumerate(pairs[:OWN_WORDS])}
    n_end = ends.n if ends else 0
    tokens, types = sums.tokens or 0, sums.types
    own_tokens = sum(n for _, n in pairs[:OWN_WORDS]) + n_end
    rare_tokens, rare_types = tokens - own_tokens, types - len(own) - bool(ends)
    rare = counts.join(
        counts.sparkSession.createDataFrame([(k,) for k in [*own, end]], "key long"), "key", "left_anti"
    )
    by_count = {r.n: r.types for r in rare.where("n <= 2").groupBy("n").agg(F.count("*").alias("types")).collect()}
    once, twice = by_count.get(1, 0), by_count.get(2, 0)
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.1
    held = dict(pairs) | ({end: n_end} if ends else {})
    own[end] = len(own)
    shares = np.array([*[n for _, n in pairs[:OWN_WORDS]], n_end, rare_tokens], np.float64)
    # A class never seen gets half a token, so that every text has a probability.
    shares = np.maximum(shares, 0.5) / np.maximum(shares, 0.5).sum()
    return Vocabulary(held, own, tokens, types, rare_tokens, rare_types, discount, shares)


class Reader:
    """Turns texts into fingerprints and classes; remembers a bounded number of fingerprints."""

    def __init__(self, known: Vocabulary):
        self.known = known
        self.keys: dict[bytes, int] = {}

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(keys, which, classes, starts) of all texts, an end after each text.

        ``keys`` are the fingerprints of the distinct words, ``which`` gives each token's place there.
        """
        flat, sizes = tokens_of(texts)
        index = {word: n for n, word in enumerate(dict.fromkeys(flat))}
        which = np.fromiter(map(index.__getitem__, flat), np.int64, len(flat))
        if len(self.keys) > HELD_WORDS:
            self.keys.clear()
        keys = self.keys
        for word in index:
            if word not in keys:
                keys[word] = word_key(word)
        distinct = [keys[word] for word in index]
        own, rare = self.known.own, self.known.rare
        classes = np.array([own.get(k, rare) for k in distinct], np.int32)[which]
        return np.array(distinct, np.int64), which, classes, np.cumsum(sizes) - sizes


class Classes(dict):
    """The class of a word; remembers the own words and a bounded number of others."""

    def __init__(self, known: Vocabulary):
        self.own, self.rare = known.own, known.rare
        self.room = len(known.own) + RARE_HELD
        self[END] = known.own[word_key(END)]

    def __missing__(self, word: bytes) -> int:
        found = self.own.get(word_key(word), self.rare)
        if found != self.rare or len(self) < self.room:
            self[word] = found
        return found

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(classes, starts) of the tokens of all texts, an end after each text."""
        flat, sizes = tokens_of(texts)
        return np.fromiter(map(self.__getitem__, flat), np.int32, len(flat)), np.cumsum(sizes) - sizes


def _rounds(docs: DataFrame, deal: Column, tokens: int) -> tuple[DataFrame, int]:
    """The texts ``body`` with the ``round`` and the ``learner`` that take them in, and the number of rounds.

    A text's place follows from ``deal``, a hash of its row, and not from the files it came in or the
    cores there are. In a round a learner has one file of about ROUND_TOKENS tokens, in order of the
    hash; small as it is, it has one row group, which tasks do not cut.
    """
    learners = max(1, tokens // (LEAST_ROUNDS * ROUND_TOKENS))
    rounds = parts_for(tokens, ROUND_TOKENS * learners)
    dealt = docs.select("body", deal.alias("deal"))
    piece = F.pmod("deal", F.lit(rounds * learners)).cast("int")
    dealt = dealt.select(
        "body", "deal", F.floor(piece / learners).cast("int").alias("round"), (piece % learners).cast("int").alias("learner")
    )
    dealt = dealt.repartitionById(learners, "learner").sortWithinPartitions("round", "deal", "body")
    dealt = dealt.select("body", "learner", "round")
    path = fresh_dir(docs.sparkSession, "rounds")
    dealt.write.partitionBy("round").parquet(path)
    return docs.sparkSession.read.schema(dealt.schema).parquet(path), rounds


def _by_learner(batches):
    """(learner, texts) of rows that lie together, in pieces of bounded size."""
    for piece, texts in chunks(batches, "body"):
        learners = piece.column(1).to_numpy()
        cuts = np.flatnonzero(learners[1:] != learners[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
            yield int(learners[a]), texts[a:b]


def _learn(trainer: Trainer, reader: Classes, pieces) -> int:
    """Steps over all texts of ``pieces``, in batches that go on from one piece to the next; tokens seen."""
    before = len(trainer.model.target)
    left_ids, left_context, held, seen = [], [], 0, 0
    for texts in pieces:
        ids, starts = reader.read(texts)
        left_ids.append(ids)
        left_context.append(contexts(ids, starts, before))
        held += len(ids)
        seen += len(ids)
        if held >= BATCH:
            ids, around = np.concatenate(left_ids), np.concatenate(left_context)
            # Whole batches only; the rest waits for the next texts.
            stop = len(ids) - len(ids) % BATCH
            for at in range(0, stop, BATCH):
                trainer.step(ids[at : at + BATCH], around[at : at + BATCH])
            left_ids, left_context, held = [ids[stop:]], [around[stop:]], len(ids) - stop
    if held:
        trainer.step(np.concatenate(left_ids), np.concatenate(left_context))
    return seen


def train(docs: DataFrame, deal: Column, known: Vocabulary) -> Model:
    """Fit the model on all texts ``body``: in a round every learner walks over about ROUND_TOKENS tokens, then
    the learners' models and sums of squares are averaged by the tokens they saw, and the next round
    goes on from there. There are as many rounds as it takes to read all texts once. A task may hold
    several learners, one after the other, so the model does not follow from the number of cores.

    A learner hands on one set of parameters, of a size that the vocabulary's bound fixes; they are
    averaged place by place in Spark, and only the average comes to the driver.
    """
    model = start_model(known.shares)
    classes = len(known.shares)
    context = docs.sparkSession.sparkContext
    if not known.tokens:
        return model
    shared = context.broadcast(known)
    state = np.frombuffer(model.pack(), np.float32)
    half = len(state)
    state = np.append(state, np.full(half, 1e-2, np.float32))
    dealt, rounds = _rounds(docs, deal, known.tokens)
    for number in range(rounds):
        start = context.broadcast(state)

        def run(batches, start=start, number=number):
            value, begun = shared.value, start.value
            reader = Classes(value)
            for _, group in groupby(_by_learner(batches), key=itemgetter(0)):
                squares = Model.unpack(begun[half:], classes)
                trainer = Trainer(Model.unpack(begun[:half], classes), value.shares, squares, SEED + number)
                seen = _learn(trainer, reader, (texts for _, texts in group))
                packed = np.frombuffer(trainer.model.pack() + trainer.squares.pack(), np.float32)
                for at in range(0, len(packed), 1024):
                    part = packed[at : at + 1024]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(at, at + len(part))), pa.array(part.astype(np.float64) * seen), pa.array(np.full(len(part), seen))],
                        names=["place", "value", "weight"],
                    )

        parts = dealt.where(F.col("round") == number).select("body", "learner").mapInArrow(run, "place long, value double, weight long")
        mean = parts.groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("value"))
        found = mean.orderBy("place").toPandas()["value"].to_numpy(np.float32)
        # A hash may leave a round of a small table without texts.
        state = found if len(found) else state
        start.destroy()
    return Model.unpack(state[:half], classes)


SCHEMA = "row long, n_tokens long, n_known long, base double, score double, rare array<long>, times array<int>"


def _scored(docs: DataFrame, keep: list[str], known: Vocabulary, model: Model) -> DataFrame:
    """Each text's sums over the words that every task knows, and its other words with their number."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    shared = docs.sparkSession.sparkContext.broadcast((known, model.pack()))
    target = StructType(docs.select(*keep).schema.fields + _parse_datatype_string(SCHEMA).fields)

    def run(batches):
        from pyspark import TaskContext

        value, packed = shared.value
        fitted, reader = Model.unpack(packed, len(value.shares)), Reader(value)
        number = TaskContext.get().partitionId() << 40
        for piece, texts in chunks(batches, "body", SCORED_CHARS):
            distinct, which, ids, starts = reader.read(texts)
            scores = log10_probabilities(fitted, ids, contexts(ids, starts, len(value.shares)))
            keys = distinct[which]
            counts = np.array([value.count.get(k, -1) for k in distinct.tolist()], np.int64)[which]
            sent = counts >= 0
            scores[sent & (ids == value.rare)] += value.within_rare(counts[sent & (ids == value.rare)])
            base = np.where(sent, value.base(np.maximum(counts, 0)), 0.0)
            stops = np.append(starts[1:], len(ids))
            rare, times = [], []
            for a, b in zip(starts.tolist(), stops.tolist()):
                own, n = np.unique(keys[a:b][~sent[a:b]], return_counts=True)
                rare.append(own)
                times.append(n.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *piece.columns[: len(keep)],
                    pa.array(np.arange(number, number + len(texts))),
                    pa.array(stops - starts),
                    pa.array(np.add.reduceat((sent & (counts > 0)).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(scores, starts)),
                    pa.array(rare, pa.list_(pa.int64())),
                    pa.array(times, pa.list_(pa.int32())),
                ],
                names=target.names,
            )
            number += len(texts)

    return docs.select(*keep, "body").mapInArrow(run, target)


def score(docs: DataFrame, keep: list[str], training: Column, body: Column) -> DataFrame:
    """``keep``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Learns from the rows where ``training`` holds and scores all. A token's probability is that of
    its class after the two tokens before it, by the log-bilinear model, normalised over all
    classes; a rare word's is that of its class times the word's discounted share in it, where all
    unseen words together are one. ``base_score`` is the add-one unigram score.

    Words beyond the most frequent ones are looked up by a join, so no task holds the vocabulary;
    what all know, and the model, have a fixed bound. A null or empty text is its end alone.
    Without training rows every count is 0 and the model is the uniform one over its classes.
    Repeated rows score alike. An empty table gives none. Other columns are ignored.
    """
    held_out = "held_out"
    inner = [f"k{n}" for n in range(len(keep))]
    source = docs.select(
        *[F.col(f"`{k}`").alias(i) for k, i in zip(keep, inner)], (~training).alias(held_out), body.alias("body")
    )
    learned = source.where(~F.col(held_out))
    deal = F.xxhash64("body", *[F.col(i).cast("string") for i in inner])
    counts = materialize(count_words(learned), "counts")
    known = vocabulary(counts)
    model = train(learned, deal, known)
    scored = materialize(_scored(source, [*inner, held_out], known, model), "scored")
    words = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
    words = words.select("row", F.col("w.rare").alias("key"), F.col("w.times").alias("times"))
    # Only words that no task knows can be in the join, so frequent ones make no hot key.
    found = words.join(counts, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    log_all = float(np.log10(known.tokens + known.types + 1))
    if known.rare_tokens:
        seen = F.log10((F.col("n") - known.discount) / known.rare_tokens)
        unseen = float(known.within_rare(0))
        within = F.when(F.col("n") > 0, seen).otherwise(F.lit(unseen))
    else:
        within = F.lit(0.0)
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * (F.log10(F.col("n") + F.lit(1.0)) - log_all)).alias("more_base"),
        F.sum(F.col("times") * within).alias("more_score"),
    )
    return scored.drop("rare", "times").join(sums, "row", "left").select(
        *[F.col(i).alias(k) for k, i in zip(keep, inner)],
        held_out,
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
