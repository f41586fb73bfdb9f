"""Text of a cell, as ``str()`` of the value would print it."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
)

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


#: Exponents of ten that scale a double's last binary place to at least one decimal place.
_LEAST, _MOST = -292, 324


#: Whole numbers beyond 63 bits are worked with in limbs of 31 bits, whose products fit a bigint.
_LIMB = 31
_LIMBS = 5


def _powers() -> str:
    """10**i for i from _LEAST to _MOST, cut to 126 bits and rounded up, as limbs, least first."""
    limbs = []
    for i in range(_LEAST, _MOST + 1):
        over, under = (10 ** i, 1) if i >= 0 else (1, 10 ** -i)
        places = 127 - over.bit_length() + under.bit_length()
        power = 1 << 127
        while power >> 126:
            places -= 1
            power = (over << max(places, 0)) // (under << max(-places, 0))
        limbs += [str(power + 1 >> _LIMB * j & (1 << _LIMB) - 1) for j in range(_LIMBS)]
    return ",".join(limbs)


_POWERS = _powers()


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _two_to(n: Column) -> Column:
    return F.pow(F.lit(2.0), n)  # exact for whole n in range


def _binary(size: Column) -> Column:
    """``struct(c, q)`` with size = c * 2**q exactly; c has 53 bits, fewer only for the smallest doubles."""
    def scaled(q: Column) -> Column:
        half = F.floor(q / 2)  # in two steps, as 2**-q alone may be out of range
        return size * _two_to(-half) * _two_to(half - q)

    def mended(q: Column) -> Column:
        # the logarithm may be one off beside a power of two
        return _let(scaled(q), lambda c: F.when(c >= 2.0 ** 53, q + 1).when(
            (c < 2.0 ** 52) & (q > -1074), q - 1).otherwise(q))

    guess = F.greatest(F.floor(F.log2(size)) - 52, F.lit(-1074).cast("bigint"))
    return _let(_let(guess, mended), lambda q: F.struct(
        scaled(q).cast("bigint").alias("c"), q.alias("q")))


def _nearest(size: Column) -> Column:
    """``struct(n string, k)``: n * 10**k is the shortest decimal that reads back as ``size``, and of these the nearest.

    The interval of numbers that read back as a double is scaled by a power of ten such that it is
    2 to 20 wide; it then holds a whole number, and at most one multiple of ten. Quarter units are
    computed from 126 bits of the power, with the last bit set if anything is left over, which
    leaves all comparisons exact (the Schubfach method, R. Giulietti, 2020).
    """
    powers = F.split(F.lit(_POWERS), ",").cast("array<bigint>")

    def low(n: Column) -> Column:
        return n.bitwiseAND(F.lit((1 << _LIMB) - 1))

    def high(n: Column) -> Column:
        return F.shiftright(n, _LIMB)

    def scale(v: Column) -> Column:
        c, q = v["c"], v["q"]
        even_gap = (c != 2 ** 52) | (q == -1074)  # below a power of two, doubles lie twice as close
        k = F.floor(q * math.log10(2) + F.when(even_gap, 0.0).otherwise(math.log10(0.75)))
        return _let(k, lambda k: F.struct(
            k.alias("k"), (c % 2).alias("odd"), (c * 4).alias("at"),
            (c * 4 - F.when(even_gap, 2).otherwise(1)).alias("from"), (c * 4 + 2).alias("to"),
            _two_to(q + F.floor(-k * math.log2(10)) + 2).cast("bigint").alias("shift"),
            *[F.get(powers, ((-k - _LEAST) * _LIMBS + j).cast("int")).alias(f"g{j}") for j in range(_LIMBS)]))

    def times(v: Column, name: str) -> Column:
        """That bound times the power, over 2**127; the last bit is set if bits 64 to 126 are not all 0."""
        def product(n: Column) -> Column:
            g = [v[f"g{j}"] for j in range(_LIMBS)]
            a, b = low(n), high(n)
            at62 = g[2] * a + g[1] * b + high(g[1] * a + g[0] * b + high(g[0] * a))
            return _let(at62, lambda at62: _let(
                g[3] * a + g[2] * b + high(at62), lambda at93: _let(
                    g[4] * a + g[3] * b + high(at93) + g[4] * b * 2 ** _LIMB, lambda at124:
                    F.shiftright(at124, 3).bitwiseOR(F.when(
                        (at124 % 8 != 0) | (low(at93) != 0) | (low(at62) >= 4), 1).otherwise(0).cast("bigint")))))

        return _let(v[name] * v["shift"], product)

    def choose(v: Column) -> Column:
        units, at, odd = F.shiftright(v["at"], 2), v["at"], v["odd"]
        tens = units - units % 10

        def inside(n: Column, above: bool) -> Column:
            return n * 4 + odd <= v["to"] if above else v["from"] + odd <= n * 4

        down10, up10 = inside(tens, False), inside(tens + 10, True)
        down, up = inside(units, False), inside(units + 1, True)
        middle = units * 4 + 2
        return (
            F.when(down10 != up10, F.when(down10, tens).otherwise(tens + 10))
            .when(down != up, F.when(down, units).otherwise(units + 1))
            .when((at < middle) | ((at == middle) & (units % 2 == 0)), units)
            .otherwise(units + 1))

    scaled = _let(_binary(size), scale)
    bounds = _let(scaled, lambda v: F.struct(
        v["k"].alias("k"), v["odd"].alias("odd"), *[times(v, x).alias(x) for x in ("at", "from", "to")]))
    return _let(bounds, lambda v: F.struct(choose(v).cast("string").alias("n"), v["k"].alias("k")))


def fewest_digits(x: Column) -> Column:
    """Text with the fewest digits that read back as ``x``, and of these the nearest.

    The JVM may print more digits than needed, so long results are tried again at 15, 16 and 17
    digits. From 1e17 on and below 1e-20 it may also miss a shorter or nearer one; there
    long results are worked out in whole numbers, which takes some five times as long.
    """
    size = F.abs(x)
    at15, at16, at17 = (F.format_string(form, x) for form in ("%.14e", "%.15e", "%.16e"))
    exact = _let(_nearest(size), lambda v: F.concat(
        F.when(x < 0, "-").otherwise(""), F.substring(v["n"], 1, 1), F.lit("."),
        F.substring(v["n"], 2, 20), F.lit("E"), (F.length(v["n"]) - 1 + v["k"]).cast("string")))
    return (
        F.when(x.isNull(), F.lit(None))
        .when(F.isnan(x) | (size == 0) | (size == float("inf")), x.cast("string"))
        # two decimals of 15 digits never read back as one double, but for the smallest
        .when((F.length(x.cast("string")) < 17) & (size >= 1e-307), x.cast("string"))
        .when((size >= 1e17) | (size < 1e-20), exact)
        .when(at15.cast("double") == x, at15)
        .when(at16.cast("double") == x, at16)
        .otherwise(at17)
    )


def double_text(x: Column, digits: Column | None = None) -> Column:
    """Text of a double: plain for 1e-4 <= abs < 1e16, else with an exponent.

    Each step feeds the next one once; nesting them several times over would repeat the
    number formatting in the generated code. ``digits`` may be a column that holds
    ``fewest_digits(x)`` already.
    """
    size = F.abs(x)
    digits = fewest_digits(x) if digits is None else digits
    plain = F.regexp_replace(
        digits.cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    # d.ddd000E20 -> d.ddde~20, then the sign and two exponent digits.
    powered = F.regexp_replace(
        digits, r"^(-?\d)(\.\d*?[1-9])?\.?0*[eE]\+?(-?)(\d+)$", "$1$2e$3~$4")
    powered = F.replace(powered, F.lit("e~"), F.lit("e+~"))
    powered = F.replace(
        F.regexp_replace(powered, r"~(\d)$", "~0$1"), F.lit("~"), F.lit(""))
    return (
        F.when(F.isnan(x), "nan")
        .when(x == float("inf"), "inf")
        .when(x == float("-inf"), "-inf")
        .when((size == 0) | ((F.length(x.cast("string")) < 17) & (size >= 1e-3) & (size < 1e7)),
              x.cast("string"))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(powered)
    )


def py_text(value: Column, kind: DataType) -> Column:
    """``str(value)`` for a column of type ``kind``; null reads ``None``."""
    if isinstance(kind, StringType):
        text = value
    elif isinstance(kind, BooleanType):
        text = F.when(value, "True").when(~value, "False")
    elif isinstance(kind, _WHOLE):
        text = value.cast("string")
    elif isinstance(kind, DoubleType):
        text = F.when(value.isNotNull(), double_text(value))
    elif isinstance(kind, FloatType):
        # A 32-bit float is widened first and prints with the digits of the double.
        text = F.when(value.isNotNull(), double_text(value.cast("double")))
    else:
        raise TypeError(f"no cell text for type {kind.simpleString()}")
    return F.coalesce(text, F.lit("None"))
