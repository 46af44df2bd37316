"""Null-aware arithmetic helpers, all plain Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwise.params import FALLBACK_STATE_FLAG, STATE_FLAGS


def clip_low(value: Column, low: float) -> Column:
    """Raise values below ``low`` to it; NULL stays NULL (``greatest`` would hide it)."""
    return F.when(value < F.lit(low), F.lit(low)).otherwise(value)


def ratio(top: Column, bottom: Column, default: float | None = None) -> Column:
    """``top / bottom`` where the bottom is positive, else the default."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(default).cast("double"))


def tidy(value: Column | str, digits: int) -> Column:
    """Half-up rounding. Noise far below the digits goes first, so sums of doubles in any order round alike."""
    return F.round(F.round(value, digits + 8), digits)


def tidy_even(value: Column | str, digits: int) -> Column:
    """Half-even rounding that first drops float noise."""
    return F.bround(F.round(value, digits + 8), digits)


def flag(condition: Column) -> Column:
    """Condition to 0/1, NULL counting as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def lookup(key: Column, table: dict[str, float], default: float) -> Column:
    """Small literal dictionary as a CASE, with a default for unknown keys."""
    chain = None
    for name, value in table.items():
        chain = (F if chain is None else chain).when(key == name, F.lit(value))
    return chain.otherwise(F.lit(default))


def own_state_flag(state: Column) -> Column:
    """Benefit-day flag of the row's own state."""
    chain = None
    for name, column in STATE_FLAGS.items():
        chain = (F if chain is None else chain).when(state == name, F.coalesce(F.col(column), F.lit(0)))
    return chain.otherwise(F.coalesce(F.col(FALLBACK_STATE_FLAG), F.lit(0))).cast("int")


def cents(price: Column) -> Column:
    """Price in whole cents: sums are exact, in any order, and stay in long arithmetic."""
    return F.round(price * 100).cast("bigint")


def from_cents(total: Column) -> Column:
    """Whole cents back to an exact amount."""
    return (total.cast("decimal(28,0)") / 100).cast("decimal(30,2)")


def calendar_parts(date: Column) -> dict[str, Column]:
    """Calendar features of a date; day_of_week counts Monday as 0, weeks are ISO weeks."""
    dow = F.weekday(date)
    return {
        "day_of_week": dow,
        "week_of_year": F.weekofyear(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year": F.year(date),
        "is_weekend": (dow >= 5).cast("int"),
    }


def fixed_text(x: Column, places: int) -> Column:
    """Text with a fixed number (2 at most) of decimal places of the exact binary value, half to even: 2.675 is a little less, so 2.67.

    A double is a whole number of 54 bits over a power of two, so everything is done in whole numbers. Values of 2**40 and more have
    too few binary places for a tie between decimals of this kind and are formatted as they are.
    """
    unit = 10**places
    size = F.abs(x)
    # Few enough bits for a 64-bit product; a value below 2**-9 lies nowhere near a tie.
    bits = F.least(F.lit(53) - F.floor(F.log2(size)), F.lit(62)).cast("int")
    whole = (size * F.pow(F.lit(2.0), bits)).cast("bigint") * F.lit(unit).cast("bigint")
    power = F.expr("1L")
    one = lambda n: F.call_function("shiftleft", power, n)
    low = F.call_function("mod", whole, one(bits))
    floor_ = F.call_function("shiftright", whole, bits)
    half = one(bits - 1)
    up = (low > half) | ((low == half) & (F.call_function("mod", floor_, F.lit(2)) == 1))
    number = F.when(size == 0, F.lit(0).cast("bigint")).otherwise(floor_ + up.cast("bigint"))
    sign = F.when(x < 0, "-").otherwise("")
    text = F.concat(sign, F.floor(number / unit).cast("string"), F.lit("."), F.lpad((number % unit).cast("string"), places, "0"))
    return F.when(size < 2.0**40, text).when(x.isNotNull(), F.format_string(f"%.{places}f", x))
