"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Every word slot has a random index vector; a word's vector adds to it the index vectors of the
words around it, over the training sample. A word's shape (cases, digits, marks, length, repetition)
is a pseudo-word with an index vector of its own. A document is the mean and the spread of its word
vectors and the mean of its shape vectors. A two-layer network in numpy gives a logit, and a
temperature fitted on documents kept out of training makes it a probability.

Words are hashed to slots, so the model's size is fixed. It is fitted on at most ``sample``
labelled documents; every document is scored by its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidelane.llm.common import stored, text_blocks, word_hashes

SLOTS, DIMS, SHAPES, SHAPE_DIMS = 1 << 14, 64, 1 << 11, 32
WINDOW = 2
#: Bytes of text, and words of which vectors are held, at a time.
BLOCK_BYTES, WORDS = 1 << 17, 1 << 14
#: Tasks that the sample is dealt to.
TASKS = 16
_SUMS = [f"s{k}" for k in range(DIMS)]


def index_vectors(rows: int, dims: int, seed: int) -> np.ndarray:
    """Random vectors with an eighth of the places at 1 or -1."""
    deal = np.random.default_rng(seed)
    return (deal.integers(0, 8, (rows, dims)) == 0) * (2 * deal.integers(0, 2, (rows, dims)) - 1).astype(np.int8)


WORD_INDEX, SHAPE_INDEX = index_vectors(SLOTS, DIMS, 1), index_vectors(SHAPES, SHAPE_DIMS, 2)

_KIND = np.full(256, 3)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 0, 1, 2, 1


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot and shape of each word, and the first word of each row."""
    hashes, first, starts, ends = word_hashes(data, bounds)
    slots = (hashes % np.uint64(SLOTS)).astype(np.int64)
    kind = _KIND[data]
    counts = []
    for k in (0, 1, 2, 3):
        sums = np.r_[0, np.cumsum(kind == k)]
        counts.append(sums[ends] - sums[starts])
    upper, lower, digits, marks = counts
    again = np.zeros(len(slots), np.int64)
    again[1:] = hashes[1:] == hashes[:-1]
    shape = np.minimum(upper, 2)
    shape = shape * 3 + np.minimum(lower, 2)
    shape = shape * 3 + np.minimum(digits, 2)
    shape = shape * 4 + np.minimum(marks, 3)
    shape = shape * 5 + np.searchsorted([2, 4, 8, 13], ends - starts, "right")
    return slots, (shape * 2 + again) % SHAPES, first


def _per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows' words; 0 for rows without."""
    out = np.zeros((len(first) - 1, values.shape[1]), np.float64)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, first[:-1][full], axis=0)
    return out


def _row_groups(first: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` words; a longer row stands alone."""
    at = 0
    while at < len(first) - 1:
        end = max(int(np.searchsorted(first, first[at] + most, "right")) - 1, at + 1)
        yield at, end
        at = end


def pooled(texts: pa.Array, vectors: np.ndarray, most: int = WORDS) -> np.ndarray:
    """Features of each text; vectors of at most ``most`` words are held at a time.

    A longer text is added up in stretches from its own start, so equal texts have equal features
    wherever they stand.
    """
    out = [np.empty((0, 2 * DIMS + SHAPE_DIMS + 1))]
    for _, data, bounds in text_blocks(texts, BLOCK_BYTES):
        slots, shapes, first = _words(data, bounds)
        for low, high in _row_groups(first, most):
            own_first = first[low : high + 1]
            sums, squares, shape = (np.zeros((high - low, n)) for n in (DIMS, DIMS, SHAPE_DIMS))
            for at in range(int(own_first[0]), int(own_first[-1]), most):
                end = min(at + most, int(own_first[-1]))
                cut = np.clip(own_first, at, end) - at
                own = vectors[slots[at:end]]
                sums += _per_row(own, cut)
                np.multiply(own, own, out=own)
                squares += _per_row(own, cut)
                shape += _per_row(SHAPE_INDEX[shapes[at:end]].astype(np.float32), cut)
            words = np.maximum(np.diff(own_first), 1)[:, None]
            mean = sums / words
            spread = np.sqrt(np.maximum(squares / words - mean * mean, 0))
            out.append(np.hstack([mean, spread, shape / words, np.log1p(np.diff(own_first))[:, None] / 10]))
    return np.concatenate(out)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors around each slot's words, in whole numbers."""
    total = np.zeros((SLOTS, DIMS), np.int64)
    for batch in batches:
        for _, data, bounds in text_blocks(batch["text"], BLOCK_BYTES):
            slots, _, first = _words(data, bounds)
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            for at in range(0, len(slots), WORDS):
                here = np.arange(at, min(at + WORDS, len(slots)))
                around = np.zeros((len(here), DIMS), np.int32)
                for d in (d for k in range(1, WINDOW + 1) for d in (-k, k)):
                    there = np.clip(here + d, 0, len(slots) - 1)
                    same = (there == here + d) & (row[there] == row[here])
                    around += WORD_INDEX[slots[there]] * same[:, None]
                own = slots[here]
                order = np.argsort(own, kind="stable")
                cut = np.flatnonzero(np.r_[True, np.diff(own[order]) > 0])
                total[own[order][cut]] += np.add.reduceat(around[order], cut, axis=0)
    used = np.flatnonzero(total.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(total[used, k]) for k in range(DIMS))], ["slot", *_SUMS])


@dataclass
class Network:
    """Standardised features, a hidden layer with rectifiers, a logit divided by the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -10, 10)
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, *, hidden: int = 32, epochs: int = 40, rate: float = 0.003, decay: float = 1e-4, seed: int = 5) -> "Network":
        deal = np.random.default_rng(seed)
        mean, scale = x.mean(0), x.std(0) + 1e-6
        net = Network(mean, scale, deal.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), deal.normal(0, hidden**-0.5, hidden), 0.0)
        z = np.clip((x - mean) / scale, -10, 10)
        held = [np.zeros_like(v) for v in (net.w1, net.b1, net.w2, np.zeros(1))]
        squares = [np.zeros_like(v) for v in held]
        t = 0
        for _ in range(epochs):
            order = deal.permutation(len(y))
            for at in range(0, len(y), 128):
                rows = order[at : at + 128]
                layer = np.maximum(z[rows] @ net.w1 + net.b1, 0)
                gap = (1 / (1 + np.exp(-np.clip(layer @ net.w2 + net.b2, -40, 40))) - y[rows]) / len(rows)
                back = np.outer(gap, net.w2) * (layer > 0)
                steps = [z[rows].T @ back + decay * net.w1, back.sum(0), layer.T @ gap + decay * net.w2, np.array([gap.sum()])]
                t += 1
                moves = []
                for k, g in enumerate(steps):
                    held[k] = 0.9 * held[k] + 0.1 * g
                    squares[k] = 0.999 * squares[k] + 0.001 * g * g
                    moves.append(rate * held[k] / (1 - 0.9**t) / (np.sqrt(squares[k] / (1 - 0.999**t)) + 1e-8))
                net.w1, net.b1, net.w2, net.b2 = net.w1 - moves[0], net.b1 - moves[1], net.w2 - moves[2], net.b2 - float(moves[3][0])
        return net

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss on other documents."""
        if not len(y):
            return
        logits = self.logits(x)
        grid = np.exp(np.linspace(np.log(0.2), np.log(10), 200))
        losses = [np.mean(np.logaddexp(0, np.where(y > 0, -1, 1) * logits / t)) for t in grid]
        self.temperature = float(grid[int(np.argmin(losses))])


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", sample: int = 12_000) -> tuple[np.ndarray, Network | float]:
    """Word vectors and a network (or, without both labels, the share of good labels) from ``labels``.

    Held-out rows and null labels take no part; of the others, ``sample`` are taken by a hash of the
    id. One in eight of these sets the temperature. Sample, word sums (``SLOTS`` times ``DIMS``) and
    features reach the driver; all are bounded by parameters.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Ids that repeat give one text, the one with the smallest hash, so the sample stays bounded. It is stored, and read twice.
    chosen = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    rows = rows.join(F.broadcast(known), "doc_id").repartition(TASKS, "doc_id").groupBy("doc_id", "label").agg(chosen.alias("chosen"))
    rows = stored(rows.select("doc_id", "label", "chosen.text"), "sample")
    sums = rows.select("text").mapInArrow(_contexts, ", ".join(f"{name} long" for name in ("slot", *_SUMS)))
    added = sums.groupBy("slot").agg(*[F.sum(name).alias(name) for name in _SUMS]).toArrow()
    around = np.zeros((SLOTS, DIMS))
    around[added["slot"].to_numpy()] = np.stack([added[name].to_numpy() for name in _SUMS], axis=1)
    unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    vectors = (unit(WORD_INDEX.astype(float)) + unit(around)).astype(np.float32)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches):
        for batch in batches:
            x = pooled(batch["text"], sent.value)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    found = rows.mapInArrow(features, "doc_id long, label int, x array<double>").toArrow().combine_chunks()
    ids, y = found["doc_id"].to_numpy(), found["label"].to_numpy()
    order = np.argsort(ids, kind="stable")
    if len(set(y.tolist())) < 2:
        return vectors, (float(y.sum()) + 1) / (len(y) + 2)
    x = np.stack(found["x"].to_numpy(zero_copy_only=False))[order]
    y, ids = y[order].astype(float), ids[order]
    late = (ids * 2654435761 % 8) == 0
    net = Network.fit(x[~late], y[~late])
    net.calibrate(x[late], y[late])
    return vectors, net


def score(docs: DataFrame, model: tuple[np.ndarray, Network | float]) -> DataFrame:
    """``docs`` with ``score``, the probability of a good document; other columns stay, ``score`` is replaced.

    Null and empty texts have no words; they get what the network makes of none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vectors, net = sent.value
        for column in texts:
            found = np.full(len(column), net) if isinstance(net, float) else net.scores(pooled(column, vectors))
            yield pa.array(found, pa.float64())

    # Only texts go to Python and only scores come back.
    return docs.withColumn("score", scored.asNondeterministic()(F.col("text").cast("string")))


def classify(docs: DataFrame, labels: DataFrame, *, least: float = 0.3, sample: int = 12_000) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (1 from a score of ``least``).

    Labels teach; they, ``lang``, ``source`` and ``doc_id`` are no inputs of a score, so equal texts
    score the same. Rows that repeat are scored each; a null id is never held out. An empty table
    gives no rows; without labels of both kinds every row gets the same score.
    """
    scored = score(docs.drop("held_out", "predicted"), fit(docs, labels, sample=sample))
    return scored.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= least).cast("int")})
