"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions alone.

A text's paragraphs (lines, cut after every ``PARAGRAPH_WORDS`` words) are hashed to 64-bit
digests. A sketch has three ranges of cells; a digest goes to one cell in each, where a count and
the XOR of digests and of their check hashes are kept. One sketch minus another holds just the
digests that differ; a cell with count 1 or -1 and a fitting check gives one of them away, which is
then taken out of its other cells, until the sketch is empty. If cells remain, the sketches were
too small, and are built again at twice the size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidelane.llm.ranges import with_next

PARAGRAPH_WORDS = 16
#: Cells of the sketch that is written out as the fingerprint.
CELLS = 48
ATTEMPTS = 8
ROUNDS = 24
_CHECK = 99
_CELLS_TYPE = "array<struct<cell:int,cnt:int,key:bigint,chk:bigint>>"


def _no_cells() -> Column:
    return F.array().cast(_CELLS_TYPE)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row. An aggregate over nothing, as ``transform`` would copy what ``body`` gives."""
    return F.aggregate(F.array(), value, lambda acc, _: acc, body)


def digests(text: Column) -> Column:
    """Distinct paragraph digests of a text (null: none)."""
    pieces = F.regexp_extract_all(
        F.coalesce(text, F.lit("")), F.lit(rf"(?:[^\s]++[^\S\n]*+){{1,{PARAGRAPH_WORDS}}}+"), F.lit(0)
    )
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(F.rtrim(p))))


def _units(keys: Column, sign: int) -> Column:
    """Each digest as what it adds to its cells."""
    return F.transform(
        keys,
        lambda k: F.struct(
            F.lit(0).alias("cell"), F.lit(sign).alias("cnt"), k.alias("key"), F.xxhash64(k, F.lit(_CHECK)).alias("chk")
        ),
    )


def _place(cell: Column, item: Column) -> Column:
    """A cell and the place of an item that adds to it, as one number that sorts by cell."""
    return F.shiftleft(cell.cast("long"), 32).bitwiseOR(item.cast("long"))


def _summed(cells: Column, units: Column, third: Column) -> Column:
    """Cells and digests (``_units``) added up by cell; cells that come to nothing are left out.

    What goes where is sorted as plain numbers, and each run of one cell is added up by the places it
    spans, as a slice would copy the whole array: the work is linear but for the sort.
    """

    def summed(items: Column) -> Column:
        own = F.size(cells)
        places = F.concat(
            F.transform(cells, lambda c, i: _place(c["cell"], i)),
            F.flatten(
                F.transform(
                    units,
                    lambda u, i: F.array(*[_place(F.pmod(F.xxhash64(u["key"], F.lit(j)), third) + j * third, own + i) for j in range(3)]),
                )
            ),
        )
        return F.when(F.size(items) == 0, _no_cells()).otherwise(_let(F.sort_array(places), lambda at: grouped(items, at)))

    def grouped(items: Column, at: Column) -> Column:
        cell = lambda n: F.shiftright(F.get(at, n), 32).cast("int")
        item = lambda n: F.get(items, F.get(at, n).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))

        def cell_of(start: Column, end: Column) -> Column:
            def cell_as(cnt: Column, key: Column, chk: Column) -> Column:
                return F.struct(cell(start).alias("cell"), cnt.alias("cnt"), key.alias("key"), chk.alias("chk"))

            def add(acc: Column, n: Column) -> Column:
                e = item(n)
                return F.struct(
                    acc["cell"].alias("cell"), (acc["cnt"] + e["cnt"]).alias("cnt"), acc["key"].bitwiseXOR(e["key"]).alias("key"),
                    acc["chk"].bitwiseXOR(e["chk"]).alias("chk"),
                )

            first = _let(item(start), lambda e: cell_as(e["cnt"], e["key"], e["chk"]))
            return F.when(end == start + 1, first).otherwise(F.aggregate(F.sequence(start + 1, end - 1), first, add))

        starts = F.filter(F.sequence(F.lit(0), F.size(at) - 1), lambda n: (n == 0) | (cell(n) != cell(n - 1)))

        def cut(starts: Column) -> Column:
            cells = F.transform(starts, lambda s, g: cell_of(s, F.coalesce(F.get(starts, g + 1), F.size(at))))
            return F.filter(cells, lambda c: (c["cnt"] != 0) | (c["key"] != 0))

        return _let(starts, cut)

    return _let(F.concat(cells, units), summed)


def sketch(keys: Column, cells: int = CELLS) -> Column:
    """The sketch of digests, as its cells in use in their order."""
    return _let(_units(keys, 1), lambda units: _summed(_no_cells(), units, F.lit(cells // 3)))


def written(cells: Column) -> Column:
    """A sketch as text: ``cell:count:digests:checks`` in hexadecimal, comma-joined."""
    return F.array_join(
        F.transform(cells, lambda c: F.concat_ws(":", F.hex(c["cell"].cast("long")), c["cnt"].cast("string"), F.hex(c["key"]), F.hex(c["chk"]))), ","
    )


def _peeled(cells: Column, third: Column) -> Column:
    """``ok`` (nothing is left) and ``found``: digests with 1 (only first) or -1 (only second)."""

    def state(cells, plus, minus, stuck) -> Column:
        return F.struct(cells.alias("cells"), plus.alias("plus"), minus.alias("minus"), stuck.alias("stuck"))

    def round_(acc: Column, _: Column) -> Column:
        pure = F.filter(acc["cells"], lambda c: (F.abs(c["cnt"]) == 1) & (c["chk"] == F.xxhash64(c["key"], F.lit(_CHECK))))

        # A digest may be alone in two of its cells. Numbers are made distinct by hash, structs would be pair by pair.
        def side(pure: Column, sign: int) -> Column:
            return F.array_distinct(F.transform(F.filter(pure, lambda c: c["cnt"] == sign), lambda c: c["key"]))

        def step(p: Column) -> Column:
            found = F.concat(_units(p["plus"], -1), _units(p["minus"], 1))
            left = _let(found, lambda units: _summed(acc["cells"], units, third))
            return state(left, F.concat(acc["plus"], p["plus"]), F.concat(acc["minus"], p["minus"]), F.lit(False))

        def taken(p: Column) -> Column:
            none = F.size(p["plus"]) + F.size(p["minus"]) == 0
            return F.when(none, state(acc["cells"], acc["plus"], acc["minus"], F.lit(True))).otherwise(step(p))

        sides = _let(pure, lambda x: F.struct(side(x, 1).alias("plus"), side(x, -1).alias("minus")))
        return F.when(acc["stuck"] | (F.size(acc["cells"]) == 0), acc).otherwise(_let(sides, taken))

    def found(keys: Column, sign: int) -> Column:
        return F.transform(keys, lambda k: F.struct(F.lit(sign).alias("cnt"), k.alias("key")))

    none = F.array().cast("array<bigint>")
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        state(cells, none, none, F.lit(False)),
        round_,
        lambda acc: F.struct((F.size(acc["cells"]) == 0).alias("ok"), F.concat(found(acc["plus"], 1), found(acc["minus"], -1)).alias("found")),
    )


def minus(a: Column, b: Column) -> Column:
    """One sketch less another of the same size."""
    taken = F.transform(b, lambda c: F.struct(c["cell"].alias("cell"), (-c["cnt"]).alias("cnt"), c["key"].alias("key"), c["chk"].alias("chk")))
    return _let(F.concat(a, taken), lambda cells: _summed(cells, _no_cells(), F.lit(1)))


def differing(a: Column, b: Column, sketch_a: Column | None = None, sketch_b: Column | None = None) -> Column:
    """``ok`` and ``found``, the digests in which two arrays of distinct digests differ.

    The sketches of ``CELLS`` cells (the fingerprints, which may be given) are subtracted and peeled
    first. Where that fails, sketches of 3 cells for each digest of both are built, or of twice
    ``CELLS`` if that is more, and each further attempt doubles them. ``ok`` is false if all ``ATTEMPTS``
    sizes failed, for which even two digests in one sketch would have to share all three cells each time.
    """
    total = F.size(a) + F.size(b)
    small = F.lit(CELLS // 3)
    first = minus(sketch(a) if sketch_a is None else sketch_a, sketch(b) if sketch_b is None else sketch_b)

    def attempt(acc: Column, i: Column) -> Column:
        third = F.greatest(F.lit(2 * CELLS // 3).cast("long"), total.cast("long")) * F.pow(F.lit(2), i).cast("long")
        units = F.concat(_units(a, 1), _units(b, -1))
        tried = _let(third, lambda t: _let(_let(units, lambda u: _summed(_no_cells(), u, t)), lambda cells: _peeled(cells, t)))
        return F.when(acc["ok"], acc).otherwise(tried)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ATTEMPTS - 2)), _let(first, lambda cells: _peeled(cells, small)), attempt)


def likeness(a: Column, b: Column, differing_: Column) -> Column:
    """Jaccard likeness of two digest sets by the number of digests that differ; 1 for two empty ones."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise((both - differing_) / (both + differing_)).cast("double")


def edited(text: Column, following: Column) -> Column:
    """The last half of ``text`` (rounded down) replaced by as much of the start of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, their likeness, and that to the next text's.

    Also ``changed`` and ``next_changed``: the digests that peeling recovered, with 1 where only
    the text itself has them and -1 where only the other has. Null texts are empty; an empty text
    has an empty fingerprint, like (1.0) only to another one. Ids that repeat are ordered by text,
    null ids come first; a table of one row is followed by itself; an empty one gives no rows.
    Other columns of ``docs`` are not looked at.
    """
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # Digests travel with their text, so each text's are made once for itself and for the text before.
    rows = rows.select("doc_id", F.struct("text", digests(F.col("text")).alias("keys")).alias("unit"))
    rows = with_next(rows, "doc_id", "unit", "following", ranges).select("doc_id", "unit.*", "following")
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("following.text")))
    rows = rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        F.col("keys").alias("own"), digests(F.col("edited")).alias("new"), F.col("following.keys").alias("next"),
    )
    sketches = {f"{name}_sketch": sketch(F.col(name)) for name in ("own", "new", "next")}
    rows = rows.withColumns(sketches).withColumns(
        {
            "changed": differing(F.col("own"), F.col("new"), F.col("own_sketch"), F.col("new_sketch")),
            "next_changed": differing(F.col("own"), F.col("next"), F.col("own_sketch"), F.col("next_sketch")),
        }
    )
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        written(F.col("own_sketch")).alias("fingerprint"), written(F.col("new_sketch")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new"), F.size("changed.found")).alias("near_edited"),
        likeness(F.col("own"), F.col("next"), F.size("next_changed.found")).alias("near_next"),
        "changed", "next_changed",
    )
