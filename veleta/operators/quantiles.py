"""Exact order statistics by radix selection (AGG14 median).

Every value is taken as a 64-bit number, or several, in the order of the values. A round counts the
values by their next 16 bits, for all columns in one pass with map-side combining, keeps the
counts in which a wanted rank falls, and goes on with the values that share its bits. So the
result has the column's own type and all of its digits, four passes are enough for any 64-bit
type, whatever the number or the spread of values, and a task holds 65,536 counts of a column at
most.
"""

from __future__ import annotations

import datetime as dt
import math
import struct
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Context, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veleta.session import stabilise

DIGIT, LIMB = 16, 64
_SIGN = 1 << 63
# Digits of a decimal that fit one limb, and of each of the three limbs of a wider one.
_LOW, _PART = 18, 13
_EXACT = Context(prec=60)
_EPOCH = dt.datetime(1970, 1, 1)


def _bound(value: Column, then) -> Column:
    """then(value), with the value worked out once however often it is used."""
    return F.transform(F.array(value), then)[0]


def _bits(v: Column) -> Column:
    """Bits of a double as a signed number in the order of the doubles, out of plain arithmetic.

    Doubles are sign, exponent and fraction, so they sort like these numbers. Scaling by powers of
    two is exact.
    """
    size = F.abs(v)
    guess = F.greatest(F.floor(F.log2(size)).cast("int"), F.lit(-1022))

    def number(guess: Column, scaled: Column) -> Column:
        # The logarithm may be off by one next to a power of two.
        low = (scaled < 1) & (guess > -1022)
        exponent = F.when(scaled >= 2, guess + 1).when(low, guess - 1).otherwise(guess)
        fraction = F.when(scaled >= 2, scaled / 2).when(low, scaled * 2).otherwise(scaled)
        # 2^52 more than the fraction, or a number without a leading one.
        return (exponent + 1022).cast("long") * F.lit(1 << 52) + (fraction * F.lit(2.0**52)).cast("long")

    def scale(guess: Column) -> Column:
        half = F.floor(guess / 2).cast("int")
        return size / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), guess - half)

    normal = _bound(guess, lambda g: _bound(scale(g), lambda scaled: number(g, scaled)))
    whole = F.when(size == 0, F.lit(0)).when(size == F.lit(math.inf), F.lit(0x7FF << 52)).otherwise(normal).cast("long")
    return F.when(v < 0, -whole).otherwise(whole)


def _from_bits(bits: int) -> float:
    value = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -value if bits < 0 else value


@dataclass(frozen=True)
class _Kind:
    """Limbs of a column, each a signed 64-bit number, and the value that limbs stand for."""

    limbs: list[Column]
    value: object


def _kind(field: T.StructField) -> _Kind:
    c, t = F.col(f"`{field.name}`"), field.dataType
    if isinstance(t, (T.DoubleType, T.FloatType)):
        v = c.cast("double")
        return _Kind([_bits(F.when(~F.isnan(v), v))], lambda x: _from_bits(x[0]))
    if isinstance(t, T.DecimalType):
        unit = Decimal(1).scaleb(-t.scale)
        if t.precision > _LOW:
            return _wide(c, unit)
        return _Kind([(c * F.lit(10**t.scale).cast("decimal(19,0)")).cast("long")], lambda x: _EXACT.multiply(Decimal(x[0]), unit))
    if isinstance(t, T.DateType):
        return _Kind([F.unix_date(c).cast("long")], lambda x: (_EPOCH + dt.timedelta(days=x[0])).date())
    if isinstance(t, T.TimestampType):
        # Given as Spark gives timestamps to Python: in the zone of the process.
        return _Kind([F.unix_micros(c)], lambda x: (_EPOCH.replace(tzinfo=dt.UTC) + dt.timedelta(microseconds=x[0])).astimezone().replace(tzinfo=None))
    if isinstance(t, T.IntegralType):
        return _Kind([c.cast("long")], lambda x: x[0])
    raise TypeError(f"no order statistics of {field.name}, which is {t.simpleString()}")


def _wide(c: Column, unit: Decimal) -> _Kind:
    """A decimal of more than 18 digits in three limbs, cut as text so that no digit is lost."""
    digits = F.lpad(F.translate(c.cast("string"), "-.", ""), 39, "0")
    sign = F.when(c < 0, F.lit(-1)).when(c.isNotNull(), F.lit(1))
    limbs = [digits.substr(1 + k * _PART, _PART).cast("long") * sign for k in range(3)]
    return _Kind(limbs, lambda x: _EXACT.multiply(Decimal((x[0] * 10**_PART + x[1]) * 10**_PART + x[2]), unit))


def _digit(limb: Column, round_: int) -> Column:
    """The next 16 bits of a limb, from the top; the first ones are signed."""
    shifted = F.shiftright(limb, LIMB - DIGIT * (round_ + 1))
    return shifted if round_ == 0 else shifted.bitwiseAND(F.lit((1 << DIGIT) - 1).cast("long"))


@dataclass
class _Path:
    """Bits known of the values that hold some wanted ranks of a column: whole limbs, then digits."""

    column: int
    limbs: tuple[int, ...]
    prefix: int
    ranks: dict[int, int]  # wanted rank of the column: rank among the values of this path

    def holds(self, kind: _Kind, round_: int) -> Column:
        test = kind.limbs[0].isNotNull()
        for limb, known in zip(kind.limbs, self.limbs):
            test = test & (limb == F.lit(known))
        if round_:
            test = test & (F.shiftright(kind.limbs[len(self.limbs)], LIMB - DIGIT * round_) == F.lit(self.prefix))
        return test


def _round(df: DataFrame, kinds: list[_Kind], paths: list[_Path], round_: int) -> list[_Path]:
    """Paths that are 16 bits longer; one pass over the rows."""
    found = [
        F.when(p.holds(kinds[p.column], round_), F.struct(F.lit(i).alias("path"), _digit(kinds[p.column].limbs[len(p.limbs)], round_).alias("digit")))
        for i, p in enumerate(paths)
    ]
    counts = df.select(F.explode(F.array_compact(F.array(*found))).alias("f")).groupBy("f.path", "f.digit").agg(F.count("*").alias("n"))
    upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("path").orderBy("digit")))
    wanted = [(i, rank, at) for i, p in enumerate(paths) for rank, at in p.ranks.items()]
    asked = df.sparkSession.createDataFrame(wanted, "path int, rank long, at long")
    # One row for every wanted rank.
    hits = upto.join(F.broadcast(asked), "path").where("upto - n < at AND at <= upto").select("path", "digit", "rank", (F.col("at") - F.col("upto") + F.col("n")).alias("left"))
    longer: dict[tuple, _Path] = {}
    for r in hits.collect():
        p = paths[r["path"]]
        prefix = (p.prefix << DIGIT) + r["digit"] if round_ else r["digit"]
        own = longer.setdefault((p.column, p.limbs, prefix), _Path(p.column, p.limbs, prefix, {}))
        own.ranks[r["rank"]] = r["left"]
    return list(longer.values())


def _select(df: DataFrame, ranks: Mapping[str, Sequence[int]]) -> dict[tuple[str, int], object]:
    cols = [c for c in ranks if ranks[c]]
    if not cols:
        return {}
    kinds, limbs = [], []
    for i, c in enumerate(cols):
        kind = _kind(df.schema[c])
        names = [f"l{i}_{k}" for k in range(len(kind.limbs))]
        limbs += [limb.alias(name) for limb, name in zip(kind.limbs, names)]
        kinds.append(_Kind([F.col(name) for name in names], kind.value))
    # Bits are worked out once; each round reads the stored numbers.
    df = stabilise(df.select(*limbs), "limbs")
    paths = [_Path(i, (), 0, {r: r for r in ranks[c]}) for i, c in enumerate(cols)]
    done: dict[tuple[str, int], object] = {}
    while paths:
        for round_ in range(LIMB // DIGIT):
            paths = _round(df, kinds, paths, round_)
        whole = [_Path(p.column, (*p.limbs, p.prefix), 0, p.ranks) for p in paths]
        for p in whole:
            if len(p.limbs) == len(kinds[p.column].limbs):
                done |= {(cols[p.column], rank): kinds[p.column].value(p.limbs) for rank in p.ranks}
        paths = [p for p in whole if len(p.limbs) < len(kinds[p.column].limbs)]
    return done


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]]) -> dict[tuple[str, int], object]:
    """Exact values at the given ranks (from 1) of numbers, dates and timestamps, in the column's own type.

    NULL and NaN are left out; minus zero counts as zero. A rank beyond the values is absent from
    the result.
    """
    return _select(df, ranks)


def known_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Values of each column that are neither NULL nor NaN."""
    return df.agg(*[F.count(_kind(df.schema[c]).limbs[0]).alias(c) for c in cols]).first().asDict() if cols else {}


def _between(a, b):
    """Mean of the two middle values, exact where the type can hold it."""
    if a == b:
        return a
    if isinstance(a, int):
        return (a + b) // 2 if (a + b) % 2 == 0 else (a + b) / 2
    if isinstance(a, float):
        return (a + b) / 2 if math.isfinite(a + b) else a / 2 + b / 2
    return _EXACT.divide(_EXACT.add(a, b), Decimal(2)) if isinstance(a, Decimal) else a + (b - a) / 2


def exact_medians(df: DataFrame, cols: Sequence[str], sizes: Mapping[str, int] | None = None) -> dict[str, object]:
    """Median of each column: the middle value, or the mean of the two middle values.

    `sizes` are the counts of known values, where they are known already.
    """
    if not cols:
        return {}
    sizes = known_counts(df, cols) if sizes is None else sizes
    wanted = {c: sorted({(sizes[c] + 1) // 2, sizes[c] // 2 + 1}) for c in cols if sizes[c]}
    got = _select(df, wanted)
    return {c: _between(got[c, wanted[c][0]], got[c, wanted[c][-1]]) if c in wanted else None for c in cols}
