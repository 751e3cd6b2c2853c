"""Mixing sources to target weights: iterative proportional fitting and calibrated sampling.

Tokens are added up by cells of source, language and topic. Only classes that have a target are
told apart, the others are one class, so cells are as many as the targets allow, whatever the data.
What is drawn in all is a fixed share of the tokens: a class too scarce for its target is drawn
whole, and the others make up for what it lacks.
Raking scales the cells' sampling probabilities by one margin after the other until the expected
tokens of every class are on target, with no probability above 1. Each document is then drawn by a
hash of its id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidelane.llm.common import stored, text_blocks, word_bounds

OTHER = "other"
#: Topics told apart by which letters begin most words (the earlier one in a tie).
TOPICS = {"a-f": "abcdef", "g-m": "ghijklm", "n-s": "nopqrs", "t-z": "tuvwxyz"}

Margin = dict[str, float]


def profiled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` (runs of non-blanks) and ``topic`` of each whole text; no words: 0 and ``other``."""
    group = np.full(256, len(TOPICS), np.int64)
    for k, letters in enumerate(TOPICS.values()):
        group[[*letters.encode(), *letters.upper().encode()]] = k
    names = np.array([*TOPICS, OTHER], object)
    rest = docs.drop("n_tokens", "topic")
    schema = StructType([*rest.schema.fields, StructField("n_tokens", LongType()), StructField("topic", StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, topics = [np.empty(0, np.int64)], [np.empty(0, object)]
            for _, data, bounds in text_blocks(batch[text_col].cast(pa.string())):
                starts, _ = word_bounds(data, bounds)
                row = np.searchsorted(bounds, starts, "right") - 1
                width = len(TOPICS) + 1
                counts = np.bincount(row * width + group[data[starts]], minlength=(len(bounds) - 1) * width).reshape(-1, width)
                lettered = counts[:, :-1]
                tokens.append(counts.sum(1))
                topics.append(names[np.where(lettered.any(1), lettered.argmax(1), len(TOPICS))])
            added = [pa.array(np.concatenate(tokens), pa.int64()), pa.array(np.concatenate(topics), pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "n_tokens", "topic"])

    return rest.mapInArrow(scan, schema)


def class_of(value: Column, margin: Margin) -> Column:
    """The value if it has a target, else ``other``; null is ``other``."""
    value = value.cast("string")
    return F.when(value.isin([k for k in margin if k != OTHER]), value).otherwise(OTHER)


def rake(tokens: np.ndarray, targets: list[np.ndarray], *, rounds: int = 500, close: float = 1e-10) -> np.ndarray:
    """Probability per cell of the array ``tokens`` (an axis per margin) that meets the targets.

    ``targets`` has the expected tokens of each class of each axis. A class without tokens is out of
    reach and ignored; where probabilities reach 1 before a target is met, they stay at 1.
    """
    p = np.full(tokens.shape, min(1.0, float(targets[0].sum()) / max(float(tokens.sum()), 1.0)))
    for _ in range(rounds):
        worst = 0.0
        for axis, target in enumerate(targets):
            for k, wanted in enumerate(target):
                cell = [slice(None)] * tokens.ndim
                cell[axis] = k
                part, own = p[tuple(cell)], tokens[tuple(cell)]
                if not own.sum():
                    continue
                scale = _scale(part.ravel(), own.ravel().astype(float), float(wanted))
                p[tuple(cell)] = np.minimum(1.0, part * scale)
                worst = max(worst, abs(scale - 1))
        if worst < close:
            break
    return p


def _scale(p: np.ndarray, tokens: np.ndarray, wanted: float) -> float:
    """The factor at which ``sum(min(1, p * factor) * tokens)`` is ``wanted``, or at which all are 1."""
    use = (p > 0) & (tokens > 0)
    p, tokens = p[use], tokens[use]
    if not len(p):
        return 1.0
    order = np.argsort(-p, kind="stable")
    p, tokens = p[order], tokens[order]
    full = np.r_[0.0, np.cumsum(tokens)]
    rest = np.r_[np.cumsum((p * tokens)[::-1])[::-1], 0.0]
    for k in range(len(p)):  # the k most likely cells are at 1
        factor = (wanted - full[k]) / rest[k]
        if p[k] * factor <= 1:
            return max(factor, 0.0)
    return 1 / p[-1]


def tempered(tokens: dict[str, float], power: float) -> Margin:
    """Shares in proportion to a power of the tokens; under 1, small classes gain. ``other`` keeps its share."""
    total = sum(tokens.values())
    raised = {k: v**power for k, v in tokens.items() if v > 0 and k != OTHER}
    other = tokens.get(OTHER, 0) / total if total else 0.0
    shares = {k: (1 - other) * v / sum(raised.values()) for k, v in raised.items()}
    return shares | ({OTHER: other} if other else {})


def reachable(share: np.ndarray, own: np.ndarray, drawn: float) -> np.ndarray:
    """Targets by ``share`` that add up to ``drawn`` where no class has more than its ``own`` tokens.

    What a scarce class lacks goes to the others in proportion to their shares.
    """
    target, open_ = np.zeros(len(own)), share > 0
    while open_.any():
        wish = share * (max(drawn - target.sum(), 0.0) / share[open_].sum())
        scarce = open_ & (wish >= own)
        if not scarce.any():
            return np.where(open_, wish, target)
        target, open_ = np.where(scarce, own, target), open_ & ~scarce
    return target


def mix(
    docs: DataFrame, margins: dict[str, Margin] | None = None, *, classes: dict[str, list[str] | int] | None = None, power: float = 0.8,
    budget: float = 0.8, seed: int = 17, id_col: str = "doc_id",
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``topic``, ``probability``, ``weight`` (its inverse) and ``sampled``.

    ``margins`` has the target share of each class of ``source``, ``lang`` and ``topic``; values
    without a target, and nulls, share what is left to 1 as ``other``. Without ``margins``, the
    ``classes`` named (a number: so many with the most tokens; others are one) get shares by
    ``tempered`` of their tokens. ``budget`` is the share of all tokens to draw, less where classes
    with a share above 0 have not that many. A class with fewer tokens than its target is drawn
    whole and the rest of its target is spread over the others (``reachable``), so that no scarce
    class bounds what is drawn. A document without words is drawn like those of its cell; a cell
    without tokens is drawn whole, as it weighs nothing.
    Rows with one id are drawn together; rows with a null id are drawn by their texts. An empty table gives no rows.
    Columns named like the added ones are replaced; other columns stay.
    """
    docs = profiled(docs.drop("n_tokens", "topic", "probability", "weight", "sampled"))
    classes = dict(classes or {})
    names = list(margins or classes)
    heavy = [] if margins else [name for name in names if isinstance(classes[name], int)]

    def key_of(name: str, column: Column) -> Column:
        return class_of(column, margins[name] if margins else dict.fromkeys(classes[name], 0.0))

    first = {name: F.col(name).cast("string") if name in heavy else key_of(name, F.col(name)) for name in names}
    cells = docs.groupBy(*[v.alias(f"_c_{name}") for name, v in first.items()]).agg(F.sum("n_tokens").alias("tokens"))
    if heavy:
        cells = stored(cells, "mix-cells")
        for name in heavy:
            key = F.col(f"_c_{name}")
            most = cells.filter(key != OTHER).groupBy(key).agg(F.sum("tokens").alias("tokens")).sort(F.desc("tokens"), key)
            classes[name] = [r[0] for r in most.limit(classes[name]).collect()]
        cells = cells.groupBy(*[key_of(name, F.col(f"_c_{name}")).alias(f"_c_{name}") for name in names]).agg(F.sum("tokens").alias("tokens"))
    rows = cells.collect()
    keys = {f"_c_{name}": key_of(name, F.col(name)) for name in names}
    axes = [sorted({r[k] for r in rows}) for k in keys]
    tokens = np.zeros([len(a) for a in axes], np.int64)
    for r in rows:
        tokens[tuple(a.index(r[k]) for a, k in zip(axes, keys, strict=True))] = r.tokens
    shares = []
    for axis, (name, labels) in enumerate(zip(names, axes, strict=True)):
        own = tokens.sum(axis=tuple(i for i in range(len(names)) if i != axis))
        margin = margins[name] if margins else tempered(dict(zip(labels, own.tolist(), strict=True)), power)
        share = np.array([margin.get(x, max(0.0, 1 - sum(margin.values())) if x == OTHER else 0.0) for x in labels])
        share = np.where(own > 0, share, 0.0)
        shares.append((share / share.sum() if share.sum() else share, own))
    drawn = min([float(budget) * float(tokens.sum()), *(float(own[share > 0].sum()) for share, own in shares)])
    p = rake(tokens, [reachable(share, own, drawn) for share, own in shares]) if tokens.size else tokens
    p = np.where(tokens > 0, p, 1.0)
    chance = F.lit(1.0)
    if tokens.size:
        at = [F.array_position(F.lit(labels), key) - 1 for labels, key in zip(axes, keys.values(), strict=True)]
        flat = F.lit(0).cast("long")
        for n, i in zip(tokens.shape, at, strict=True):
            flat = flat * n + i
        chance = F.get(F.lit([float(x) for x in p.ravel()]), flat.cast("int"))
    # Rows without an id are told apart by their text.
    name = F.coalesce(F.col(id_col).cast("long"), F.xxhash64("text"))
    unit = F.shiftrightunsigned(F.xxhash64(name, F.lit(seed)), 11) / float(1 << 53)
    return docs.withColumn("probability", chance).withColumns(
        {"weight": F.when(F.col("probability") > 0, 1 / F.col("probability")), "sampled": unit < F.col("probability")}
    )
