"""Money text such as ``"$1,200.50"`` as numbers, and sums of it that are exact and never fail.

An amount is taken apart so that sums need whole numbers only: ``whole`` units and ``micro``
millionths of an amount below 2^23 with up to six decimal places, which are nearly all;
``rest``, a decimal with twelve places, of others below 10^15; ``far``, a double, of amounts
beyond, where a double has no cents. Sums of the first two hold 2^40 rows, and sums of parts have the same parts, so
that rollups can be summed up again. Values become doubles only at the end.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Amounts from here on are ``rest``, and from there on ``far``.
PLAIN_BELOW, REST_BELOW = float(1 << 23), 1e15
_MICROS = 1_000_000
_PARTS = ("whole", "micro", "rest", "far")


def _bare(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("$"), F.lit("")), F.lit(","), F.lit(""))


def to_number(text: Column) -> Column:
    """Number in money text, null when it cannot be read or is not finite."""
    number = _bare(text).try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def _micros(number: Column) -> Column:
    """Millionths of a plain amount, null for others. The nearest double of so many millionths is the amount itself."""
    millionths = F.rint(number * _MICROS)
    plain = (F.abs(number) < PLAIN_BELOW) & (millionths / _MICROS == number)
    return F.when(plain, millionths.cast("bigint"))


def to_exact(text: Column, number: Column | None = None) -> Column:
    """The parts of an amount; a thirteenth decimal place is rounded half up. ``number`` is the text's, if at hand."""
    number = to_number(text) if number is None else number
    micros = _micros(number)
    rest = F.when(micros.isNull() & (F.abs(number) < REST_BELOW), _bare(text).try_cast("decimal(27,12)"))
    far = F.when(F.abs(number) >= REST_BELOW, number)
    parts = (F.call_function("div", micros, F.lit(_MICROS)), micros % _MICROS, rest, far)
    return F.when(number.isNotNull(), F.struct(*[p.alias(name) for p, name in zip(parts, _PARTS)]))


def add(exact: Column) -> Column:
    """Aggregate: the sum of amounts or of sums, in parts."""
    return F.struct(*[F.sum(exact[name]).alias(name) for name in _PARTS])


def units(exact: Column) -> Column:
    """An amount or a sum as the nearest double, null for a sum of nothing."""
    whole, micro, rest, far = (exact[name] for name in _PARTS)
    zero = F.lit(0)
    fraction = F.coalesce(micro, zero).cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(7,6)")
    near = F.coalesce(whole, zero).cast("decimal(19,0)") + fraction + F.coalesce(rest, zero.cast("decimal(37,12)"))
    known = F.coalesce(whole.cast("double"), rest.cast("double"), far)
    return F.when(known.isNotNull(), F.when(far.isNull(), near.cast("double")).otherwise(near.cast("double") + far))


def total(exact: Column) -> Column:
    return units(add(exact))


def mean(exact: Column) -> Column:
    return F.try_divide(total(exact), F.count(exact))


def squares(exact: Column, number: Column) -> Column:
    """Aggregate: the sum of the squares of amounts, for plain ones exactly in millionths squared, for others as a double."""
    micros = (exact["whole"] * _MICROS + exact["micro"]).cast("decimal(13,0)")
    return F.struct(F.sum(micros * micros).alias("plain"), F.sum(F.when(micros.isNull(), number * number)).alias("other"))


def add_squares(squared: Column) -> Column:
    """Aggregate: the sum of sums of squares."""
    return F.struct(F.sum(squared["plain"]).alias("plain"), F.sum(squared["other"]).alias("other"))


def spread(count: Column, exact: Column, squared: Column) -> Column:
    """Sample standard deviation of so many amounts from their sum and the sum of their squares; null for less than two.

    Exact up to the root while all amounts are plain and the products have no more than 38 digits, else in doubles.
    """
    wide, none = "decimal(38,0)", exact["rest"].isNull() & exact["far"].isNull()
    micros = exact["whole"].cast(wide) * _MICROS + exact["micro"].cast(wide)
    number = count.cast(wide)
    plain = F.try_subtract(F.try_multiply(number, squared["plain"].cast(wide)), F.try_multiply(micros, micros))
    square = F.coalesce(squared["plain"].cast("double") / 1e12, F.lit(0.0)) + F.coalesce(squared["other"], F.lit(0.0))
    rough = F.greatest(count * square - units(exact) * units(exact), F.lit(0.0))
    scaled = F.coalesce(F.when(none, plain.cast("double") / 1e12), rough)
    return F.when(count > 1, F.sqrt(scaled / count / (count - 1)))
