"""Personal data in texts: patterns propose spans, checksums confirm them, context words score them.

All of it is DataFrame functions. ``split`` and ``regexp_extract_all`` cut a text by one pattern into
gaps and matches in turn; their lengths give the places. Patterns are possessive and look behind
only where that can't change a match, so that long runs of digits or letters take linear time.
Account codes only have their starts proposed that way, each with all that may belong to it, as what
follows a code may look like more of it; the country's length and the checksum find the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: What each kind proposes, a character its matches need, and words that speak for it.
KINDS = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", ["mail", "contact", "write to"],
    ),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", ["ip", "host", "server", "address"]),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", None, ["card", "visa", "credit", "payment"]),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+", ["phone", "tel", "call", "mobile", "fax"]),
    "iban": (r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])))", None, ["iban", "account", "bank", "transfer"]),
}
#: Characters of an account code by country.
CODE_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
        31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
BASE = ["email", "ip", "card", "phone"]
#: Code points before and after a match in which context words count.
CONTEXT = 40
#: Matches that are gathered at a time; lists grow by so many.
CHUNK = 256
_SPAN = "array<struct<kind:string,start:long,end:long,score:double>>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.sequence(F.lit(1), F.length(digits))
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        digit = F.ascii(F.substring(back, i, F.lit(1))) - 48
        return F.when(i % 2 == 0, F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)).otherwise(digit)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code, its first four characters put last and letters as 10 to 35, leaves 1."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, F.lit(1), F.lit(4)))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c <= 57, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _email(_: Column) -> Column:
    return F.lit(True)


def _ip(match: Column) -> Column:
    def small(part: Column) -> Column:
        short = F.ltrim(part, F.lit("0"))
        return (F.length(short) <= 3) & (F.coalesce(short.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(match, r"\."), small)


def _card(match: Column) -> Column:
    digits = _digits(match)
    return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(8, 15)


CHECKS: dict[str, Callable[[Column], Column]] = {"email": _email, "ip": _ip, "card": _card, "phone": _phone}
#: Score of a span that passed its check, without and with a context word near it.
SCORES = {"email": (0.9, 1.0), "ip": (0.5, 0.9), "card": (0.8, 1.0), "phone": (0.6, 0.95), "iban": (0.9, 1.0)}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.aggregate(F.array(), value, lambda acc, _: acc, body)


def _gathered(items: Column, start: dict[str, Column], step: Callable[[Column, Column], tuple[dict[str, Column], Column, Column]]) -> Column:
    """Spans of ``items`` in their order: ``step`` of a state and an item's number gives the next state, whether there is a span, and it.

    Spans are gathered by ``CHUNK`` items and the chunks put together at the end, so that a long
    list isn't copied for each of them.
    """
    none = F.array().cast(_SPAN)
    state = lambda values, name, spans: F.struct(*[c.alias(k) for k, c in values.items()], spans.alias(name))

    def chunk(acc: Column, first: Column) -> Column:
        def one(inner: Column, i: Column) -> Column:
            values, found, span = step(inner, i)
            return state(values, "spans", F.when(found, F.concat(inner["spans"], F.array(span))).otherwise(inner["spans"]))

        numbers = F.sequence(first, F.least(first + (CHUNK - 1), F.size(items) - 1))
        inner = F.aggregate(numbers, state({k: acc[k] for k in start}, "spans", none), one)
        return _let(inner, lambda x: state({k: x[k] for k in start}, "chunks", F.concat(acc["chunks"], F.array(x["spans"]))))

    firsts = F.sequence(F.lit(0), F.size(items) - 1, F.lit(CHUNK))
    return F.aggregate(firsts, state(start, "chunks", F.array().cast(f"array<{_SPAN}>")), chunk, lambda acc: F.flatten(acc["chunks"]))


def _near(words: list[str]) -> str:
    return rf"(?i)\b(?:{'|'.join(words)})\b"


def spans_of(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind in their order: kind, start, end (code points), score."""
    pattern, needs, words = KINDS[kind]
    check, (low, high) = CHECKS[kind], SCORES[kind]
    near = _near(words)
    cut = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))

    def spans(items: Column) -> Column:
        def step(acc: Column, i: Column) -> tuple[dict[str, Column], Column, Column]:
            gap, match = F.get(items, i)["gap"], F.get(items, i)["match"]
            after = F.coalesce(F.get(items, i + 1)["gap"], F.lit(""))
            start = acc["at"] + F.length(gap)
            end = start + F.coalesce(F.length(match), F.lit(0))
            told = F.right(gap, F.lit(CONTEXT)).rlike(near) | F.left(after, F.lit(CONTEXT)).rlike(near)
            span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), F.when(told, high).otherwise(low).alias("score"))
            return {"at": end}, F.when(match.isNull(), False).otherwise(check(match)), span

        return _gathered(items, {"at": F.lit(0).cast("long")}, step)

    return F.when(text.contains(needs), _let(cut, spans)).otherwise(F.array().cast(_SPAN)) if needs else _let(cut, spans)


def code_of(proposed: Column) -> Column:
    """The longest account code that ``proposed`` starts with and that ends before a blank or with it; null without one.

    Its length is its country's, or 15 to 34 characters if that isn't known, and it passes mod-97.
    """
    groups = F.split(proposed, " ")
    least, most = (F.coalesce(F.get(F.lit(list(CODE_LENGTHS.values())), F.array_position(F.lit(list(CODE_LENGTHS)), F.left(proposed, F.lit(2))).cast("int") - 1), F.lit(n)) for n in (15, 34))

    def fits(code: Column) -> Column:
        bare = F.replace(code, F.lit(" "), F.lit(""))
        return F.when(F.length(bare).between(least, most), mod97(bare)).otherwise(False)

    starts = F.transform(F.sequence(F.size(groups), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(groups, 1, n), " "))
    return F.get(F.filter(starts, fits), F.lit(0))


def code_spans_of(text: Column) -> Column:
    """``spans_of`` account codes. No code begins inside the one before it."""
    pattern, _, words = KINDS["iban"]
    low, high = SCORES["iban"]
    # A blank in front, as ``split`` leaves out an empty gap before an empty match at the start.
    text = F.concat(F.lit(" "), text)
    cut = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("proposed"))
    cut = F.transform(cut, lambda x: F.struct(x["gap"].alias("gap"), x["proposed"].alias("proposed"), code_of(x["proposed"]).alias("code")))
    near = _near(words)

    def spans(items: Column) -> Column:
        def step(acc: Column, i: Column) -> tuple[dict[str, Column], Column, Column]:
            x = F.get(items, i)
            start = acc["at"] + F.length(x["gap"])
            before = F.right(F.concat(acc["before"], x["gap"]), F.lit(CONTEXT))
            own = F.right(before, F.greatest(start - acc["end"], F.lit(0)).cast("int"))
            # What follows the code begins with the next gap, which starts at the code itself.
            after = F.substring(F.coalesce(F.get(items, i + 1)["gap"], F.lit("")), F.length(x["code"]) + 1, F.lit(CONTEXT))
            score = F.when(own.rlike(near) | after.rlike(near), high).otherwise(low)
            end = start + F.length(x["code"])
            span = F.struct(F.lit("iban").alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))
            found = x["code"].isNotNull() & (start >= acc["end"])
            return {"at": start, "end": F.when(found, end).otherwise(acc["end"]), "before": before}, found, span

        # Places in the text as it was: the first gap has the blank in front.
        return _gathered(items, {"at": F.lit(-1).cast("long"), "end": F.lit(0).cast("long"), "before": F.lit("")}, step)

    return _let(cut, spans)


def find_pii(docs: DataFrame, *, text_col: str = "text", kinds: list[str] = list(KINDS)) -> DataFrame:  # noqa: B006
    """``docs`` with ``pii``: the spans of all kinds, by kind in the order given, then by start.

    A span's score says how sure it is: its kind's checksum or form alone, or also a context word, whole,
    within ``CONTEXT`` code points before or after it, no further than the next match (of account
    codes: proposal, or code before it) of its kind. Null and empty
    texts have no spans. Spans of different kinds may overlap. Every row and every other column
    stays as it is; a column named ``pii`` is replaced.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = {f"_pii_{kind}": code_spans_of(text) if kind == "iban" else spans_of(text, kind) for kind in kinds}
    return docs.withColumns(found).withColumn("pii", F.concat(*[F.col(c) for c in found])).drop(*found)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
