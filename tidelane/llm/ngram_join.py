"""N-gram Jaccard join with signature trees.

Two documents link when their sets of word n-grams have a Jaccard likeness of at least
``percent`` in a hundred. The work, each step on all documents:

1. Equal sets are one *class*; from here on classes stand for their documents.
2. Linked sets share an n-gram among the first ``n - ceil(t n) + 1`` of each set, in any order of
   n-grams that all sets keep to. Here n-grams come by the number of sets that hold them, in powers of
   two as tasks have counted them, then by hash. So passages that many texts share come last, and what a
   text has of its own comes first. The first n-gram that two sets share is at places ``i`` and ``j``; then they
   share ``min(n_a - i, n_b - j)`` at most, and pairs that this rules out are dropped at that n-gram.
3. The *leader* of an n-gram is the class where it comes first. Each class is compared with some leaders of its
   n-grams, those of the most n-grams first. Links found so far make known components.
4. For every n-gram whose classes are in more than one known component, a *signature tree* is built:
   leaves of classes sorted by size, nodes with the OR of token bitmaps, the range of sizes and of
   components. A dual traversal drops node pairs whose greatest possible overlap or size range
   rules a link out, or which are one known component already. N-grams of many classes are cut
   into blocks, and each pair of blocks is a group of its own.
5. Pairs that remain are tested by bitmaps as wide as their sets are large, then compared exactly,
   set by set, in rounds: some of each class, then more and more of those
   that still join different components. All links are closed to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidelane.llm.common import Bits, mixed, signed, stored, text_blocks, word_hashes
from tidelane.llm.components import components

SIGNATURE_WORDS = 16
LEAF = 16
BLOCK = 1024
#: An n-gram met in so many classes of one task is counted; OFTEN_ROWS of them are handed on at a time, PENDING held before they are counted.
OFTEN, OFTEN_ROWS, PENDING = 2, 1 << 16, 1 << 20
#: Counts from 2**LEAST_LEVEL change the order, those of 2**MOST_LEVELS n-grams at most, in a table of 2**LEVEL_SLOTS places.
LEAST_LEVEL, MOST_LEVELS, LEVEL_SLOTS = 3, 20, 23
#: Leaders that a class is compared with, and pairs of a class in the first round; each later round takes as many times more.
LEADERS, ROUND = 4, 32
#: Bytes of text whose words are hashed at once, and bytes of sets that a task holds before it hands them on.
TEXT_BYTES, SET_BYTES = 1 << 18, 1 << 22
#: Rows that Python gets at a time: of texts and of sets, and of n-grams. Pairs that a traversal holds at once.
TEXTS, GRAMS, LEAF_PAIRS = 256, 8192, 1 << 12
_STEP = 0xD6E8FEB86659FD93


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's n-grams; the whole sequence where it has fewer words."""
    scale = np.array([pow(_STEP, width - 1 - i, 1 << 64) for i in range(width)], np.uint64)
    for _, data, bounds in text_blocks(texts, TEXT_BYTES):
        words, first, _, _ = word_hashes(data, bounds)
        grams = np.zeros(max(len(words) - width + 1, 0), np.uint64)
        for i in range(width):
            grams += words[i : i + len(grams)] * scale[i]
        grams = mixed(grams)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= width:
                yield np.unique(grams[a : b - width + 1])
            elif b > a:
                h = np.full(1, b - a, np.uint64)
                for w in words[a:b]:
                    h = h * np.uint64(_STEP) + w
                yield mixed(h)
            else:
                yield np.empty(0, np.uint64)


def _class_of(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


class Levels:
    """For n-grams that many sets hold, the power of two of their number: 0 for all others.

    The table is of fixed size. Where n-grams meet in a place the larger level holds for each; any levels give an order.
    """

    def __init__(self, table: np.ndarray):
        self.table = table

    @staticmethod
    def of(counted: DataFrame) -> "Levels":
        """Levels of n-grams from ``gram`` and ``c``, parts of their numbers: the highest, of 2**MOST_LEVELS n-grams at most."""
        sums = counted.groupBy("gram").agg(F.sum("c").alias("c")).filter(F.col("c") >= 1 << LEAST_LEVEL)
        level = F.floor(F.log2(F.col("c").cast("double"))).cast("int")
        found = stored(sums.select("gram", level.alias("level")), "ngram-levels")
        at_least = found.agg(*[F.count(F.when(F.col("level") >= level, 1)) for level in range(64)]).first()
        least = next((level for level in range(64) if at_least[level] <= 1 << MOST_LEVELS), 64)
        place = F.shiftrightunsigned("gram", 64 - LEVEL_SLOTS).cast("int").alias("place")
        rows = found.filter(F.col("level") >= least).select(place, F.col("level").cast("byte")).toArrow()
        table = np.zeros(1 << LEVEL_SLOTS, np.uint8)
        np.maximum.at(table, rows["place"].to_numpy(), rows["level"].to_numpy().astype(np.uint8))
        return Levels(table)

    def has(self, grams: np.ndarray) -> np.ndarray:
        return self.table[(grams >> np.uint64(64 - LEVEL_SLOTS)).astype(np.int64)]


def _prefix(grams: np.ndarray, levels: Levels, percent: int) -> np.ndarray:
    """The first n-grams of a set, by level and hash."""
    size = len(grams) - (percent * len(grams) + 99) // 100 + 1
    level = levels.has(grams)
    if level[:size].any():
        grams = grams[np.argsort(level, kind="stable")]
    # A copy, as a view would keep the whole set in memory.
    return grams[:size].copy()


def _signature(grams: np.ndarray) -> bytes:
    bits = np.zeros(64 * SIGNATURE_WORDS, np.uint8)
    bits[(grams % np.uint64(64 * SIGNATURE_WORDS)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _bitmap(grams: np.ndarray) -> bytes:
    """A bit for each n-gram, in a width of at least twice their number and a power of two."""
    width = max(64 * SIGNATURE_WORDS, 1 << (2 * len(grams) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(grams & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def ngram_components(
    docs: DataFrame, *, width: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    Words are runs of other than space and tab to carriage return, with A-Z lower-cased; the whole
    text counts. A set holds distinct runs of ``width`` words, or the whole sequence if there are
    fewer. Null and empty texts have no words: size 0, no links, their own id as component. A null id
    stays null and never names a component. Rows that repeat are copies of each other. An empty
    table gives an empty result; other columns of ``docs`` are not looked at.
    """
    found = _found(docs, width, percent, id_col, text_col)
    return found.select("doc_id", "n_shingles", "component_id")


def ngram_join(docs: DataFrame, *, width: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.

    Rows without words stay. Of rows with one id any that names its component stays. Of a component
    without any id, one row stays: one with the least hash of its text.
    """
    found = _found(docs, width, percent, "doc_id", "text")
    keep = found.filter("doc_id = component_id").select("doc_id").distinct()
    no_id = found.filter("doc_id is null")
    wordless = no_id.filter("n_shingles = 0").select(F.col("row").alias("_row")).distinct()
    least = no_id.filter("n_shingles > 0 and component_id is null").groupBy("root").agg(F.min("row").alias("_row")).select("_row")
    rows = docs.filter(F.col("doc_id").cast("long").isNull()).withColumn("_row", _row_of("doc_id", "text"))
    alike = rows.join(least, "_row", "left_semi").dropDuplicates(["_row"])
    rows = rows.join(wordless, "_row", "left_semi").unionByName(alike).select(*docs.columns)
    return docs.join(keep, "doc_id", "left_semi").select(*docs.columns).unionByName(rows)


def _row_of(id_col: str, text_col: str) -> Column:
    """Hash of a row's id and text; of the text alone if it has no id."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def _found(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``ngram_components`` with ``row`` (``_row_of``) and ``root``, the class that stands for the component."""
    spark = docs.sparkSession
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), _row_of(id_col, text_col).alias("row")
    )
    sets = _sizes(docs, width)
    members = sets.filter("kind = 0").select("doc_id", "n", "class", "row")
    counted = sets.filter("kind = 1").select(F.explode(F.arrays_zip("often", "counts")).alias("x"))
    levels = Levels.of(counted.select(F.col("x.often").alias("gram"), F.col("x.counts").alias("c")))
    firsts = _firsts(docs, width, percent, levels)
    # Of each class one row stands for all, one with an id if there is any.
    row = F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), F.col("row"))), F.min("row"))
    classes = members.filter("class is not null").groupBy("class").agg(row.alias("row"), F.min("doc_id").alias("least_id"))
    classes = stored(classes, "ngram-classes")
    return _membership(members, classes, _roots(spark, docs, classes, firsts, width, percent))


def _sizes(docs: DataFrame, width: int) -> DataFrame:
    """A row of kind 0 per document with its class, and rows of kind 1 with n-grams that a task has met often, and how often."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        pending: list[np.ndarray] = []
        held = 0
        common = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            n, classes = [], []
            for grams in shingle_sets(batch["text"], width):
                n.append(len(grams))
                classes.append(_class_of(grams) if len(grams) else None)
                if len(grams) and classes[-1] not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(classes[-1])
                    pending.append(grams.copy())
                    held += len(grams)
                    if held >= PENDING:
                        common, pending, held = _counted(common, pending, 2), [], 0
            yield _rows([0] * len(n), batch["doc_id"], n, classes, batch["row"], [None] * len(n), [None] * len(n))
        grams, counts = _counted(common, pending, OFTEN)
        for at in range(0, len(grams), OFTEN_ROWS):
            part = slice(at, at + OFTEN_ROWS)
            yield _rows([1], [None], [0], [None], [None], [signed(grams[part])], [counts[part]])

    schema = "kind int, doc_id long, n long, class long, row long, often array<long>, counts array<long>"
    return stored(docs.mapInArrow(scan, schema), "ngram-sets", TEXTS)


def _counted(common, pending: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """``common`` (n-grams and counts) with those of ``pending`` added, without what has fewer than ``least``."""
    fresh = np.sort(np.concatenate([np.empty(0, np.uint64), *pending]))
    starts = np.flatnonzero(np.r_[len(fresh) > 0, fresh[1:] != fresh[:-1]][: len(fresh)])
    fresh, counts = fresh[starts], np.diff(np.r_[starts, len(fresh)])
    at = np.searchsorted(fresh, common[0])
    known = np.zeros(len(at), bool)
    inside = at < len(fresh)
    known[inside] = fresh[at[inside]] == common[0][inside]
    counts[at[known]] += common[1][known]
    kept, rest = counts >= least, ~known & (common[1] >= least)
    grams = np.concatenate([fresh[kept], common[0][rest]])
    return grams, np.concatenate([counts[kept], common[1][rest]])


def _rows(kinds, ids, sizes, classes, rows, often, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(kinds, pa.int32()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
            pa.array(classes, pa.int64()), pa.array(rows, pa.int64()), pa.array(often, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64())),
        ],
        ["kind", "doc_id", "n", "class", "row", "often", "counts"],
    )


def _firsts(docs: DataFrame, width: int, percent: int, levels: Levels) -> DataFrame:
    """Size, signature and first n-grams of each class, once per task at most where it has copies."""
    sent = docs.sparkSession.sparkContext.broadcast(levels.table)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, seen = Levels(sent.value), set()
        for batch in batches:
            rows = []
            for grams in shingle_sets(batch["text"], width):
                if len(grams) and (k := _class_of(grams)) not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(k)
                    rows.append((k, len(grams), _signature(grams), signed(_prefix(grams, levels, percent))))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())), strict=True)],
                ["class", "n", "signature", "firsts"],
            )

    found = docs.mapInArrow(scan, "class long, n long, signature binary, firsts array<long>")
    return stored(found, "ngram-firsts", TEXTS)


def _roots(spark: SparkSession, docs: DataFrame, classes: DataFrame, firsts: DataFrame, width: int, percent: int) -> DataFrame:
    """``class`` and ``known``, the component of each class that has a link."""
    postings = firsts.select("class", "n", F.posexplode("firsts").alias("pos", "gram")).withColumn("n", F.col("n").cast("int"))
    # One sort tells the leader, classes met in several tasks, and n-grams of one class alone.
    of_gram = Window.partitionBy("gram").orderBy("pos", "class")
    whole = of_gram.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    postings = stored(
        postings.withColumns({
            "before": F.lag("class").over(of_gram), "leader": F.first("class").over(whole), "last": F.last("class").over(whole),
            "leader_pos": F.first("pos").over(whole), "leader_n": F.first("n").over(whole),
        }).filter("leader != last and (before is null or before != class)").drop("before", "last"),
        "ngram-postings",
    )
    possible = (
        f"100L * least(n, leader_n) >= {percent}L * greatest(n, leader_n) "
        f"and {100 + percent}L * least(n - pos, leader_n - leader_pos) >= {percent}L * (n + leader_n)"
    )
    led = postings.filter("class != leader").filter(possible).select("class", "leader").repartition("class")
    led = led.groupBy("class", "leader").agg(F.count("*").alias("grams"))
    turn = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("grams"), "leader"))
    led = stored(
        led.withColumn("turn", turn).filter(F.col("turn") <= LEADERS).select(F.col("class").alias("a"), F.col("leader").alias("b")), "ngram-led"
    )
    links = stored(_verified(led, *_sets_of(spark, docs, classes, led, width), percent), "ngram-led-links", TEXTS)

    known = _known(links)
    labelled = stored(
        postings.join(known, "class", "left").select("gram", "class", "n", "pos", F.coalesce("known", "class").alias("label")), "ngram-labelled"
    )
    pairs = stored(_tree_pairs(labelled, firsts, percent).distinct(), "ngram-pairs", GRAMS)

    # Round by round, more pairs of each class are compared, and only while they are in two components.
    found, most = _sets_of(spark, docs, classes, pairs, width), ROUND
    while True:
        turn = F.row_number().over(Window.partitionBy("a").orderBy(F.xxhash64("a", "b")))
        open_ = stored(pairs.select("a", "b", turn.alias("turn")), "ngram-open")
        tried = open_.filter(F.col("turn") <= most).select("a", "b")
        if tried.isEmpty():
            return known
        fresh = stored(_verified(tried, *found, percent), "ngram-links", TEXTS)
        pairs, most = open_.filter(F.col("turn") > most).select("a", "b"), ROUND * most
        if not fresh.isEmpty():
            links = links.unionByName(fresh)
            known = _known(links)
            for side in "ab":
                pairs = pairs.join(known.select(F.col("class").alias(side), F.col("known").alias(f"known_{side}")), side, "left")
            pairs = pairs.filter("coalesce(known_a, a) != coalesce(known_b, b)")


def _known(links: DataFrame) -> DataFrame:
    """``class`` and ``known``, the component of each class that has a link so far."""
    return stored(components(links, "a", "b").select(F.col("node").alias("class"), F.col("root").alias("known")), "ngram-known")


def _sets_of(spark: SparkSession, docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Of each class in ``pairs``, from its row in ``classes``: bitmap, size and the task that holds its set; the sets by task."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class"))
    bits = Bits.of(classes.join(wanted, "class", "left_semi"), "row", 24)
    sent = spark.sparkContext.broadcast((bits.words, bits.log2))

    kinds = {"class": pa.int64(), "task": pa.int32(), "n": pa.int64(), "bits": pa.binary(), "grams": pa.binary()}

    def handed_on(rows):
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], [*kinds])

    def sets(batches):
        table, seen, task = Bits(*sent.value), set(), TaskContext.get().partitionId()
        for batch in batches:
            batch = batch.filter(pa.array(table.has(batch["row"].to_numpy().view(np.uint64))))
            rows, held = [], 0
            for grams in shingle_sets(batch["text"], width) if batch.num_rows else ():
                if len(grams) and (k := _class_of(grams)) not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(k)
                    rows.append((k, task, len(grams), _bitmap(grams), grams.tobytes()))
                    held += grams.nbytes
                    if held >= SET_BYTES:
                        yield handed_on(rows)
                        rows, held = [], 0
            yield handed_on(rows)

    # A row that only the bit table lets in adds nothing false. Copies without an id can't be told apart, so many tasks may
    # hold a class; the first one's set is taken.
    found = docs.select("row", "text").mapInArrow(sets, "class long, task int, n long, bits binary, grams binary")
    found = stored(found, "ngram-texts", TEXTS)
    bitmaps = found.groupBy("class").agg(F.min("task").alias("task"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    return stored(bitmaps, "ngram-bitmaps"), found.select("class", "task", "grams")


def _verified(pairs: DataFrame, bitmaps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` of classes whose sets link."""
    pairs = stored(_near_by_bitmaps(pairs, bitmaps, percent), "ngram-near", TEXTS)
    sets = _holding(sets, pairs)
    for side in "ab":
        pairs = pairs.join(sets.select(*[F.col(c).alias(f"{c}_{side}".removeprefix("class_")) for c in sets.columns]), [side, f"task_{side}"])

    def linked(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["grams_a"], batch["grams_b"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                both = np.sort(np.concatenate([x, y]))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "grams_a", "grams_b").mapInArrow(linked, "a long, b long")


def _holding(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``sets`` for classes in ``pairs``, and few others: sets of other classes are not shuffled."""
    bits = Bits.of(pairs.select(F.explode(F.array("a", "b")).alias("class")), "class", 24)
    sent = sets.sparkSession.sparkContext.broadcast((bits.words, bits.log2))

    def scan(batches):
        table = Bits(*sent.value)
        for batch in batches:
            yield batch.filter(pa.array(table.has(batch["class"].to_numpy().view(np.uint64))))

    return sets.mapInArrow(scan, sets.schema)


def _near_by_bitmaps(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs, with the tasks that hold their sets, that bitmaps as wide as the sets are large don't rule out.

    Signatures of one width say little of long texts; these hold a sixteenth of the sets or less.
    """

    def scan(batches):
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b")), strict=True)
            keep = [(100 + percent) * _most_common(*row) >= percent * (row[0] + row[1]) for row in rows]
            yield batch.select(["a", "b", "task_a", "task_b"]).filter(pa.array(keep, pa.bool_()))

    for side in "ab":
        pairs = pairs.join(bitmaps.select(*[F.col(c).alias(f"{c}_{side}".removeprefix("class_")) for c in bitmaps.columns]), side)
    return pairs.mapInArrow(scan, "a long, b long, task_a int, task_b int")


def _most_common(n_a: int, n_b: int, bits_a: bytes, bits_b: bytes) -> int:
    """The greatest overlap that two bitmaps allow; the wider is folded to the other's width."""
    a, b = np.frombuffer(bits_a, np.uint64), np.frombuffer(bits_b, np.uint64)
    width = min(len(a), len(b))
    a, b = (np.bitwise_or.reduce(x.reshape(-1, width), axis=0) for x in (a, b))
    common = int(np.bitwise_count(a & b).sum())
    only_a, only_b = (int(np.bitwise_count(x).sum()) - common for x in (a, b))
    return min(n_a - only_a, n_b - only_b)


def _tree_pairs(labelled: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different labels that share an n-gram and may link, by signature trees."""
    # N-grams of the same classes give the same pairs: of a passage that many texts share, one n-gram will do, the one
    # that comes first in all of them, as it rules out the fewest pairs.
    marks = [F.sum(F.xxhash64(F.col("class"), F.lit(seed)).cast("decimal(20,0)")).alias(f"mark{seed}") for seed in (0, 1)]
    open_grams = labelled.groupBy("gram").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("c"), F.sum("pos").alias("places"), *marks
    ).filter("lo != hi")
    open_grams = open_grams.groupBy("c", "mark0", "mark1").agg(F.min_by("gram", "places").alias("gram")).select("gram")
    labelled = labelled.join(open_grams, "gram")

    by_label = labelled.groupBy("gram", "label").agg(F.count("*").alias("c"))
    big = F.col("c") >= BLOCK
    cuts = by_label.groupBy("gram").agg(
        F.ceil(F.sum(F.when(~big, F.col("c")).otherwise(0)) / BLOCK).cast("int").alias("shared_blocks"),
        F.sort_array(F.collect_list(F.when(big, F.struct("label", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"))))).alias("large"),
    )
    # Block names: "s<i>" for blocks of small labels, "<label>/<i>" for blocks of a large one.
    own_blocks = F.expr("element_at(filter(large, x -> x.label = label), 1).blocks")
    name = F.when(
        F.expr("exists(large, x -> x.label = label)"),
        F.concat(F.col("label").cast("string"), F.lit("/"), F.pmod(F.xxhash64("class"), own_blocks).cast("string")),
    ).otherwise(F.concat(F.lit("s"), F.pmod(F.xxhash64("label"), F.greatest("shared_blocks", F.lit(1))).cast("string")))
    others = F.expr(
        "concat(transform(sequence(0, greatest(shared_blocks, 1) - 1), i -> concat('s', i)), "
        "flatten(transform(filter(large, x -> x.label != label), x -> transform(sequence(0, x.blocks - 1), i -> concat(x.label, '/', i)))))"
    )
    placed = labelled.join(cuts, "gram").withColumns({"own": name, "other": others})
    # Side 2: a block with itself. Of two blocks, only pairs across them are wanted.
    task = lambda o: F.struct(
        F.xxhash64("gram", F.least("own", o), F.greatest("own", o)).alias("task"),
        F.when(F.col("own") == o, 2).when(F.col("own") < o, 0).otherwise(1).alias("side"),
    )
    tasks = placed.select("class", "label", "n", "pos", F.explode(F.transform("other", task)).alias("x"))
    signatures = firsts.groupBy("class").agg(F.min("signature").alias("signature"))
    rows = tasks.select("x.task", "x.side", "class", "label", "n", "pos").join(signatures, "class")
    rows = rows.select("task", "side", "class", "label", "n", "pos", "signature").repartition("task").sortWithinPartitions("task")

    def walk(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (pa.concat_tables([rest, table]) if rest is not None else table).combine_chunks()
            keys = table["task"].to_numpy()
            if not len(keys):
                continue
            last = len(keys) - int(np.argmax(keys[::-1] != keys[-1])) if keys[0] != keys[-1] else 0
            rest = table.slice(last)
            if last:
                yield from _pairs_of(table.slice(0, last), percent)
        if rest is not None and rest.num_rows:
            yield from _pairs_of(rest, percent)

    return rows.mapInArrow(walk, "a long, b long")


def _pairs_of(table: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    keys, label, n, names = (table[c].to_numpy() for c in ("task", "label", "n", "class"))
    n, left, side = n.astype(np.int64), (n - table["pos"].to_numpy()).astype(np.int64), table["side"].to_numpy()
    raw = b"".join(table["signature"].to_pylist())
    bits = np.frombuffer(raw, np.uint64).reshape(-1, SIGNATURE_WORDS)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])

    def kept(i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        keep = _may_link(n, left, label, side, bits, i, j, percent)
        lo, hi = np.minimum(names[i[keep]], names[j[keep]]), np.maximum(names[i[keep]], names[j[keep]])
        return pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo)], ["a", "b"])

    for g in np.unique(sizes[(sizes > 1) & (sizes <= LEAF)]):
        i, j = np.triu_indices(g, 1)
        at = starts[sizes == g][:, None]
        yield kept((at + i).ravel(), (at + j).ravel())
    for s, g in zip(starts[sizes > LEAF], sizes[sizes > LEAF], strict=True):
        order = s + np.argsort(n[s : s + g], kind="stable")
        tree = SignatureTree(n[order], label[order], bits[order], percent)
        for i, j in tree.pairs():
            yield kept(order[i], order[j])


def _may_link(n, left, label, side, bits, i, j, percent: int) -> np.ndarray:
    """Pairs of different labels whose greatest possible overlap is enough; ``left``: what a set has from the n-gram on."""
    least = percent * (n[i] + n[j])
    out = (label[i] != label[j]) & ((side[i] == 2) | (side[i] != side[j])) & ((100 + percent) * np.minimum(left[i], left[j]) >= least)
    at = np.flatnonzero(out)
    for at in np.split(at, np.arange(1 << 14, len(at), 1 << 14)):
        x, y = i[at], j[at]
        only_x = np.bitwise_count(bits[x] & ~bits[y]).sum(1, dtype=np.int64)
        only_y = np.bitwise_count(bits[y] & ~bits[x]).sum(1, dtype=np.int64)
        out[at] = (100 + percent) * np.minimum(n[x] - only_x, n[y] - only_y) >= least[at]
    return out


class SignatureTree:
    """Nodes over rows sorted by size; level 0 holds leaves of ``LEAF`` rows, each level above halves."""

    def __init__(self, n, label, bits, percent: int):
        self.n, self.label, self.bits, self.percent = n, label, bits, percent
        excess = n - np.bitwise_count(bits).sum(1, dtype=np.int64)
        cut = np.arange(0, len(n), LEAF)
        level = {
            "or": np.bitwise_or.reduceat(bits, cut, axis=0),
            "lo": np.minimum.reduceat(n, cut), "hi": np.maximum.reduceat(n, cut),
            "first": np.minimum.reduceat(label, cut), "last": np.maximum.reduceat(label, cut),
            "excess": np.maximum.reduceat(excess, cut),
        }
        self.levels = [level]
        fold = {"or": np.bitwise_or, "lo": np.minimum, "hi": np.maximum, "first": np.minimum, "last": np.maximum, "excess": np.maximum}
        while len(level["lo"]) > 1:
            cut = np.arange(0, len(level["lo"]), 2)
            level = {k: fold[k].reduceat(v, cut, axis=0) for k, v in level.items()}
            self.levels.append(level)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs of the leaf pairs that a traversal from the root pair can't rule out, some leaf pairs at a time."""
        i = j = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            keep = self._open(level, i, j)
            i, j = i[keep], j[keep]
            if depth:
                width = len(self.levels[depth - 1]["lo"])
                i, j = (2 * i[:, None] + [0, 0, 1, 1]).ravel(), (2 * j[:, None] + [0, 1, 0, 1]).ravel()
                inside = (i <= j) & (j < width)
                i, j = i[inside], j[inside]
        a, b = np.repeat(np.arange(LEAF), LEAF), np.tile(np.arange(LEAF), LEAF)
        for at in range(0, len(i), LEAF_PAIRS):
            x, y = (LEAF * i[at : at + LEAF_PAIRS, None] + a).ravel(), (LEAF * j[at : at + LEAF_PAIRS, None] + b).ravel()
            inside = (x < y) & (y < len(self.n))
            yield x[inside], y[inside]

    def _open(self, level, i, j) -> np.ndarray:
        one = (level["first"][i] == level["last"][i]) & (level["first"][j] == level["last"][j]) & (level["first"][i] == level["first"][j])
        sizes = 100 * level["hi"][i] >= self.percent * level["lo"][j]
        sizes &= 100 * level["hi"][j] >= self.percent * level["lo"][i]
        overlap = np.bitwise_count(level["or"][i] & level["or"][j]).sum(1, dtype=np.int64)
        most = overlap + np.minimum(level["excess"][i], level["excess"][j])
        return ~one & sizes & ((100 + self.percent) * most >= self.percent * (level["lo"][i] + level["lo"][j]))


def _membership(members: DataFrame, classes: DataFrame, known: DataFrame) -> DataFrame:
    named = classes.join(known, "class", "left").select("class", "least_id", F.coalesce("known", "class").alias("root"))
    named = stored(named, "ngram-roots")
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = named.join(ids, "root").select("class", "root", "component_id")
    return members.join(of_class, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "row", "root",
    )
