"""URL filters: rules for hosts and paths, and the likelihood ratio of two character models.

Two smoothed variable-order Markov models, of accepted and of rejected URLs, give each byte's
probability after its last bytes, from the longest context seen down to none (Witten-Bell: a context
trusts itself the more, the fewer different bytes it was followed by). The difference of the log
likelihoods per byte, against a threshold calibrated on URLs kept out of the counts, decides.

A byte and its up to four predecessors, a *gram*, fit a whole number, so contexts are exact. Models are tables
of grams that grow with the URLs and stay in Spark; each part of the rows is sent only the grams that it holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidelane.llm.common import ascii_lower, stored, text_blocks

ORDER = 4
#: Rows that are scored together, with the grams they hold.
PART = 16_384


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest (verdict, rule) that fits, as columns; null where none does.

    A rule ``host/path`` fits its host and its subdomains, if the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        at, _, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _grams(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, each byte's gram (the bytes before it and itself, above them the order) and whether the URL has as many bytes before it."""
    place = np.arange(len(data)) - np.repeat(bounds[:-1], np.diff(bounds))
    gram = data.astype(np.int64)
    for order in range(ORDER + 1):
        if order:
            gram = gram.copy()
            gram[order:] |= data[:-order].astype(np.int64) << (8 * order)
        yield gram | (order << 40), place >= order


def _longest(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each byte's gram of the highest order."""
    out = np.zeros(len(data), np.int64)
    for gram, has in _grams(data, bounds):
        out = np.where(has, gram, out)
    return out


def _counts(rows: DataFrame) -> DataFrame:
    """``gram``, ``good``, ``bad``: how often URLs of each kind that teach hold it (0 and 0: only others do)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            teaches = batch["teaches"].to_numpy(zero_copy_only=False).astype(np.int64)
            for at, data, bounds in text_blocks(batch["url"]):
                kind = np.repeat(teaches[at : at + len(bounds) - 1], np.diff(bounds))
                for gram, has in _grams(data, bounds):
                    keys, where = np.unique(gram[has], return_inverse=True)
                    good, bad = (np.bincount(where[kind[has] == k], minlength=len(keys)) for k in (1, -1))
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(good), pa.array(bad)], ["gram", "good", "bad"])

    found = rows.select("url", "teaches").mapInArrow(scan, "gram long, good long, bad long")
    return found.groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def _values(counts: DataFrame) -> DataFrame:
    """``gram``, ``value``: log probability of its last byte after the others among accepted URLs, less that among rejected ones.

    Order by order: the probability after a context is made of the counts there and the probability after the
    context without its first byte. A context is followed by at most 256 bytes, and as many grams end alike.
    """
    context = Window.partitionBy(F.shiftright("gram", 8))
    kinds = ("good", "bad")
    sums = {f"{k}_total": F.sum(k).over(context) for k in kinds} | {f"{k}_followers": F.sum(F.when(F.col(k) > 0, 1).otherwise(0)).over(context) for k in kinds}
    table = stored(counts.withColumns(sums).withColumn("order", F.shiftright("gram", 40).cast("int")), "grams")
    value = None
    shorter = None
    for order in range(ORDER + 1):
        level = table.filter(F.col("order") == order)
        if shorter is None:
            level = level.withColumns({f"{k}_before": F.lit(1 / 256) for k in kinds})
        else:
            ends = F.col("gram").bitwiseAND(F.lit((1 << 8 * order) - 1)).bitwiseOR(F.lit(order - 1 << 40))
            level = level.withColumn("ends", ends).join(shorter, "ends")
        p = {
            f"{k}_p": F.when(
                F.col(f"{k}_total") > 0,
                (F.col(k) + F.col(f"{k}_followers") * F.col(f"{k}_before")) / (F.col(f"{k}_total") + F.col(f"{k}_followers")),
            ).otherwise(F.col(f"{k}_before"))
            for k in kinds
        }
        level = level.select("gram", *[c.alias(name) for name, c in p.items()])
        level = stored(level, f"grams-{order}") if order else level
        mine = level.select("gram", (F.log("good_p") - F.log("bad_p")).alias("value"))
        value = mine if value is None else value.unionByName(mine)
        shorter = level.select(F.col("gram").alias("ends"), F.col("good_p").alias("good_before"), F.col("bad_p").alias("bad_before"))
    return value


def _scored(rows: DataFrame, values: DataFrame) -> DataFrame:
    """Adds ``score`` to rows of ``url`` and ``part``: log likelihood difference per byte; 0 for an empty URL."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch["part"].to_numpy()
            for at, data, bounds in text_blocks(batch["url"]):
                of = np.repeat(part[at : at + len(bounds) - 1], np.diff(bounds))
                grams = _longest(data, bounds)
                for one in np.unique(of):
                    keys = np.unique(grams[of == one])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), one)), pa.array(keys)], ["part", "gram"])

    schema = StructType([*rows.schema.fields, StructField("score", DoubleType())])

    def score(_: tuple, own: pa.Table, sent: pa.Table) -> pa.Table:
        gram, value = sent["gram"].to_numpy(), sent["value"].to_numpy()
        order = np.argsort(gram)
        gram, value = gram[order], value[order]
        scores = np.zeros(own.num_rows)
        urls = pa.concat_arrays([c.cast(pa.large_string()) for c in own["url"].chunks])
        for at, data, bounds in text_blocks(urls):
            if len(data):
                gaps = value[np.searchsorted(gram, _longest(data, bounds))]
                scores[at : at + len(bounds) - 1] = np.diff(np.r_[0, np.cumsum(gaps)][bounds]) / np.maximum(np.diff(bounds), 1)
        return own.append_column("score", pa.array(scores))

    # A gram, however frequent, is met once for each part.
    wanted = rows.select("part", "url").mapInArrow(held, "part long, gram long").distinct()
    sent = wanted.join(values, "gram").select("part", "gram", "value")
    return rows.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(score, schema)


def threshold(scored: DataFrame) -> float:
    """The score from which a URL is accepted: fewest errors, good and bad ones weighing the same, amid
    the gap between the scores around it; 0 without both.

    Scores are counted in a thousandth of a nat; at most the range of scores in such steps reaches
    the driver, which the smoothing bounds.
    """
    rows = scored.groupBy(F.floor(F.col("score") * 1000).alias("step")).agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    ).sort("step").collect()
    good, bad = np.array([r.good for r in rows], float), np.array([r.bad for r in rows], float)
    if not good.sum() or not bad.sum():
        return 0.0
    errors = np.r_[0, np.cumsum(good)] / good.sum() + 1 - np.r_[0, np.cumsum(bad)] / bad.sum()
    best = np.flatnonzero(errors == errors.min())
    cut = int(best[len(best) // 2])
    steps = [rows[0].step - 1, *(r.step for r in rows), rows[-1].step + 1]
    return (steps[cut] + 1 + steps[cut + 1]) / 2000


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], *, url_col: str = "url", held_out: int = 5) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score``, ``verdict`` (allow or block: the rule's, else the models').

    URLs that rules accept or reject teach the two models; one in ``held_out`` of them, by hash, is
    kept out of the counts and calibrates the threshold. Without rule hits, URLs that no rule fits
    are allowed. A null URL is empty: it fits no rule, scores 0 and is allowed if the threshold is
    at most 0. Rows that repeat count each. An empty table gives no rows. Other columns stay;
    columns named like the added ones are replaced.
    """
    own = pages.drop("host", "path", "rule", "score", "verdict")
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rows = own.select(F.struct("*").alias("row"), url.alias("url"))
    said = rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)
    kept_out = F.pmod(F.xxhash64("url"), F.lit(held_out)) == 0
    kind = F.when(said[1] == "allow", 1).when(said[1] == "block", -1).otherwise(0)
    rows = stored(rows, "urls").withColumns({"kind": kind, "part": F.floor(F.monotonically_increasing_id() / PART)})
    values = _values(_counts(rows.select("url", F.when(kept_out, 0).otherwise(F.col("kind")).alias("teaches"))))
    scored = stored(_scored(rows.select("row", "url", "kind", "part"), values), "url-scores")
    least = threshold(scored.filter(kept_out & (F.col("kind") != 0)).withColumn("good", F.col("kind") == 1))
    found = scored.select(
        "row", "score", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), said[0].alias("rule"),
        F.coalesce(said[1], F.when(F.col("score") >= least, "allow").otherwise("block")).alias("verdict"),
    )
    return found.select("row.*", "score", "host", "path", "rule", "verdict")
