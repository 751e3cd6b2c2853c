"""Time and price of a deal packed into one number that orders like the pair.

The first and last deal of a group are then a plain ``min`` and ``max`` of a
fixed-width value.  Spark keeps those in a hash aggregate with partial results
per task; with strings or structs it would have to sort the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidelane.functions.values import MONEY

# A price in cents is lifted above zero; zero stands for a missing price.
_LIFT = 10**18
_SHIFT = 2 * 10**18
# Times, of 20 digits, are counted from the middle, so that both signs of a 38-digit number are used.
_MIDDLE = 5 * 10**19
# The least time that fits stands for a missing one.
_NONE = 1


def stamp(time: Column, price: Column) -> Column:
    """Pack a 20-digit time string, of any year, and a price; equal times order by price.

    A missing time comes first, as does a missing price among equal times. A time that isn't of 20
    digits, or less than 2, counts as missing; the price stays.
    """
    digits = F.when(time.rlike("^[0-9]{20}$"), time.cast("decimal(20,0)"))
    moment = F.greatest(F.coalesce(digits, _number(_NONE)), _number(_NONE))
    cents = (price.cast(MONEY) * 100).cast("long") + _LIFT
    high = (moment - _number(_MIDDLE)).cast("decimal(20,0)") * _number(_SHIFT)
    return (high + F.coalesce(cents, F.lit(0)).cast("decimal(19,0)")).cast("decimal(38,0)")


def stamp_price(packed: Column) -> Column:
    """Price of a stamp, or null."""
    low = _low(packed)
    price = (low - F.lit(_LIFT)).cast("decimal(20,0)") / 100
    return F.when(low > 0, price.cast(MONEY))


def stamp_moment(packed: Column) -> Column:
    """Time of a stamp as a number that orders like the time; 1 if it had none."""
    high = (packed - _low(packed)).cast("decimal(38,0)") / _number(_SHIFT)
    return (high.cast("decimal(20,0)") + _number(_MIDDLE)).cast("decimal(20,0)")


def moment_time(moment: Column) -> Column:
    """Time string of a moment, or null."""
    return F.when(moment > _number(_NONE), F.lpad(moment.cast("string"), 20, "0"))


def _low(packed: Column) -> Column:
    return F.pmod(packed, _number(_SHIFT)).cast("decimal(19,0)")


def _number(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")
