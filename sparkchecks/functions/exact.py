"""Sums that lose nothing and don't depend on the order or the grouping of rows.

A finite double is a whole number of units ``2 ** (LOWEST + LIMB * bin)``, with the bin chosen by its
exponent, and that number is cut into ``LIMBS`` limbs of ``LIMB`` bits. Rows are grouped by their keys
and the bin, and limbs are summed as integers: exactly, over the whole range of doubles, with as
many rows as integers of 63 bits have room for (2 ** 43; more are an error, never a wrong sum). Such
rows are *partial sums*: they can be joined, weighted with whole numbers and summed again. At the end
the limbs of a key are carried into one number, which is rounded once to the nearest double.

Whole numbers and decimals are summed as decimals of 38 digits, which is exact as well; a sum beyond
them is an error. Texts are read as doubles, those that can't be are NULL.

NULLs are ignored; a key without values has the sum NULL. A sum with NaN, or with both infinities, is
NaN; otherwise one infinity decides. A sum beyond the largest double is infinite.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMB, LIMBS, LOWEST = 20, 4, -1074
BASE = 1 << LIMB
#: Bins of values that are no numbers: positive and negative infinity, NaN.
POSITIVE, NEGATIVE, NOT_A_NUMBER = -1, -2, -3
PARTIAL = T.StructType([T.StructField("b", T.IntegerType()), *[T.StructField(f"l{i}", T.LongType()) for i in range(LIMBS)]])


def is_partial(dtype: T.DataType) -> bool:
    """Whether a column holds partial sums of floats."""
    return isinstance(dtype, T.StructType) and dtype.fieldNames() == PARTIAL.fieldNames()


def _is_exact(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.IntegralType, T.DecimalType))


def _limbs(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame with the named double columns as partial sums of one value."""
    others = [f"`{c}`" for c in df.columns if c not in names]
    bins, units, parts = [], [], []
    for n in names:
        x, b, y = f"`{n}`", f"`{n} bin`", f"`{n} units`"
        # One step below the exponent, since logarithms are rounded.
        ulp = f"greatest(floor(log2(abs({x}))) - 53, {LOWEST})"
        bins.append(
            f"cast(CASE WHEN isnan({x}) THEN {NOT_A_NUMBER} WHEN abs({x}) = double('inf') THEN if({x} > 0, {POSITIVE}, {NEGATIVE}) "
            f"WHEN {x} = 0 THEN 0 ELSE floor(({ulp} - ({LOWEST})) / {LIMB}) END AS int) AS {b}"
        )
        # Powers of two are exact; in two steps neither the smallest nor the largest double leaves the range.
        half = f"pow(2.0D, {-LOWEST // 2} - {LIMB // 2} * {b})"
        units.append(f"if({b} >= 0, abs({x}) * {half} * {half}, 0.0D) AS {y}")
        rest, limbs = y, []
        for i in range(LIMBS - 1, 0, -1):
            limbs.append(f"floor({rest} / {BASE**i}D)")
            rest = f"({rest} - cast({limbs[-1]} AS double) * {BASE**i}D)"
        limbs.append(f"cast({rest} AS bigint)")
        fields = ", ".join(f"'l{i}', {limb} * if({x} < 0, -1L, 1L)" for i, limb in enumerate(reversed(limbs)))
        parts.append(f"if({x} IS NULL, NULL, named_struct('b', {b}, {fields})) AS {x}")
    df = df.selectExpr("*", *bins).selectExpr("*", *units)
    return df.selectExpr(*others, *parts)


def _weighted(c: str, dtype: T.DataType, weighted: bool) -> str:
    """SQL of a whole number or decimal, times the weight; no digit of its scale is given up."""
    scale = getattr(dtype, "scale", 0)
    value = c if isinstance(dtype, T.DecimalType) else f"cast({c} AS decimal(20,0))"
    if not weighted:
        return value
    # A product has the digits of both sides: whole part and fraction are multiplied apart.
    times = f"cast(_weight AS decimal({max(1, min(18, 36 - scale))},0))"
    if not scale:
        return f"{value} * {times}"
    whole = f"(CASE WHEN {value} < 0 THEN ceil({value}) ELSE floor({value}) END)"
    fraction = f"({value} % cast(1 AS decimal(1,0)))"
    return " + ".join(f"cast({part} * {times} AS decimal(37,{scale}))" for part in (whole, fraction))


def partial_sums(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, Column],
    weight: Column | None = None,
    counts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows (keys, partial sums of ``values``, ``counts``): one for each key and bin.

    Values are numbers, texts or partial sums. ``weight`` is a whole number that each row counts
    for. ``counts`` are aggregates that are whole numbers; summed over a key's rows they are its own.
    """
    inputs = {name: f"_value {name}" for name in values}
    w = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    df = df.select("*", *[c.alias(inputs[n]) for n, c in values.items()], w.alias("_weight"))
    kinds = {n: df.schema[c].dataType for n, c in inputs.items()}
    floats = {inputs[n] for n, t in kinds.items() if not _is_exact(t) and not is_partial(t)}
    if floats:
        df = df.selectExpr(*[f"try_cast(`{c}` AS double) AS `{c}`" if c in floats else f"`{c}`" for c in df.columns])
        df = _limbs(df, sorted(floats))
    bins, sums, back = [], [], []
    for n, t in kinds.items():
        c = f"`{inputs[n]}`"
        if _is_exact(t):
            sums.append(f"sum({_weighted(c, t, weight is not None)}) AS `{n}`")
            back.append(f"`{n}`")
            continue
        bins.append(F.expr(f"{c}.b AS `_bin {n}`"))
        sums += [f"sum({c}.l{i}{'' if weight is None else ' * _weight'}) AS `_limb {n} {i}`" for i in range(LIMBS)]
        fields = ", ".join(f"'l{i}', `_limb {n} {i}`" for i in range(LIMBS))
        back.append(f"if(`_bin {n}` IS NULL, NULL, named_struct('b', `_bin {n}`, {fields})) AS `{n}`")
    grouped = df.groupBy(*[F.col(f"`{k}`") for k in keys], *bins).agg(*map(F.expr, sums), *[c.alias(k) for k, c in (counts or {}).items()])
    return grouped.selectExpr(*[f"`{k}`" for k in keys], *back, *[f"`{k}`" for k in counts or {}])


def whole_sums(partial: DataFrame, keys: Sequence[str], names: Sequence[str], counts: Sequence[str] = ()) -> DataFrame:
    """One row per key: its sums, doubles where values were floats, and its counts."""
    named = [F.col(f"`{k}`") for k in keys]
    kinds = {n: partial.schema[n].dataType for n in names}
    sums = [(F.collect_list(f"`{n}`") if is_partial(t) else F.sum(f"`{n}`")).alias(n) for n, t in kinds.items()]
    out = partial.groupBy(*named).agg(*sums, *[F.sum(c).alias(c) for c in counts])
    return _rounded(out, [n for n, t in kinds.items() if is_partial(t)]).select(*named, *[F.col(f"`{n}`") for n in names], *counts)


def exact_sums(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column], counts: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per key with the exact sums of ``values``, each rounded once."""
    return whole_sums(partial_sums(df, keys, values, None, counts), keys, list(values), list(counts or {}))


def _rounded(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame with arrays of partial sums as the nearest doubles to their sums; NULL for empty ones."""
    if not names:
        return df
    columns = df.columns
    zero = "cast(0 AS decimal(38,0))"
    start = f"named_struct('carry', {zero}, 'digits', cast(array() AS array<bigint>))"
    digit = f"pmod(s.carry + t, cast({BASE} AS decimal(38,0)))"
    carry = f"cast(cast(s.carry + t - {digit} AS decimal(38,0)) / cast({BASE} AS decimal(8,0)) AS decimal(38,0))"
    step = f"(s, t) -> named_struct('carry', {carry}, 'digits', concat(s.digits, array(cast({digit} AS bigint))))"
    own = " ".join(f"WHEN {i} THEN e.l{i}" for i in range(LIMBS))
    stages: list[list[str]] = [[], [], [], [], [], []]
    values = {}
    for n in names:
        numbers, low, places, up, digits, h = (f"`{n} {x}`" for x in ("numbers", "low", "places", "up", "digits", "first"))
        stages[0].append(f"filter(`{n}`, e -> e.b >= 0) AS {numbers}")
        stages[1].append(f"array_min(transform({numbers}, e -> e.b)) AS {low}")
        # What lies at each place; beyond the highest there is room for the carries of 38 digits.
        top = f"array_max(transform({numbers}, e -> e.b)) + {LIMBS + 5}"
        at = f"aggregate({numbers}, {zero}, (s, e) -> cast(s + CASE p - e.b {own} ELSE 0L END AS decimal(38,0)))"
        stages[2].append(f"transform(sequence({low}, {top}), p -> {at}) AS {places}")
        stages[3].append(f"aggregate({places}, {start}, {step}) AS {up}")
        stages[4].append(f"if({up}.carry < 0, aggregate(transform({places}, t -> cast(-t AS decimal(38,0))), {start}, {step}).digits, {up}.digits) AS {digits}")
        stages[5].append(f"array_max(transform({digits}, (d, i) -> if(d <> 0, i, NULL))) AS {h}")
        # The leading digits, one bit for all below them, and the power of two.
        lead = " + ".join(f"cast(if({h} >= {i}, get({digits}, {h} - {i}), 0) AS decimal(7,0)) * cast({2 * BASE ** (LIMBS - 1 - i)} AS decimal(19,0))" for i in range(LIMBS))
        below = f"if(exists(slice({digits}, 1, greatest({h} - {LIMBS - 1}, 0)), d -> d <> 0), 1, 0)"
        power = f"({LOWEST - 1} + {LIMB} * ({low} + {h} - {LIMBS - 1}))"
        number = f"cast({lead} + {below} AS double) * pow(2.0D, floor({power} / 2)) * pow(2.0D, {power} - floor({power} / 2))"
        values[n] = (
            f"CASE WHEN size(`{n}`) = 0 THEN NULL WHEN exists(`{n}`, e -> e.b = {NOT_A_NUMBER}) OR (exists(`{n}`, e -> e.b = {POSITIVE}) "
            f"AND exists(`{n}`, e -> e.b = {NEGATIVE})) THEN double('NaN') WHEN exists(`{n}`, e -> e.b = {POSITIVE}) THEN double('inf') "
            f"WHEN exists(`{n}`, e -> e.b = {NEGATIVE}) THEN -double('inf') WHEN {h} IS NULL THEN 0.0D "
            f"WHEN {up}.carry < 0 THEN -({number}) ELSE {number} END AS `{n}`"
        )
    for stage in stages:
        df = df.selectExpr("*", *stage)
    return df.selectExpr(*[values.get(c, f"`{c}`") for c in columns])
