"""Totals of a measure per component, described as data.

A ``Total`` sums a column of one table; a ``SeriesTotal`` sums the elements of
an array column kept in a table of its own. ``planned_totals`` plans any number
of them, for whatever rules, with one pass per table and set of filters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.exact import partial_sums, whole_sums
from ..sources.tables import Tables


@dataclass(frozen=True)
class Dimension:
    """A table that facts must have a partner in: ``fact_column`` = ``key_column``."""

    table: str
    fact_column: str
    key_column: str
    filters: Mapping = field(default_factory=dict)


@dataclass(frozen=True)
class Total:
    """Sum of ``value`` over the rows whose ``key`` is a member of a component.

    ``members`` maps components to key values. Without a ``key`` every row that
    passes the filters counts for the one component listed. A filter value is a
    constant, a list of constants, or ``":name"`` for a parameter of the run.
    """

    table: str
    value: str
    members: Mapping[str, Sequence[str]]
    key: str | None = None
    filters: Mapping = field(default_factory=dict)
    dimension: Dimension | None = None
    divisor: float = 1.0


@dataclass(frozen=True)
class SeriesTotal:
    """Sum of array elements over facts joined to their series and dimension.

    Unlike the semi join of a ``Total`` these are inner joins: duplicates on any
    of the three sides multiply.
    """

    table: str
    key: str
    members: Mapping[str, Sequence[str]]
    series_table: str
    series_key: str
    series_value: str
    dimension: Dimension
    filters: Mapping = field(default_factory=dict)
    series_filters: Mapping = field(default_factory=dict)
    divisor: float = 1.0


#: A total to plan: its number, what it sums, and the parameters of its run.
Wanted = tuple[int, Total | SeriesTotal, Mapping]


def _bound(filters: Mapping, params: Mapping) -> dict:
    """A filter mapping with ``":name"`` values bound to ``params``."""
    return {
        column: params[wanted[1:]] if isinstance(wanted, str) and wanted.startswith(":") else wanted
        for column, wanted in filters.items()
    }


def matches(filters: Mapping, params: Mapping) -> Column:
    """The conjunction of a filter mapping, with ``":name"`` values bound to ``params``."""
    conditions = []
    for column, wanted in _bound(filters, params).items():
        if isinstance(wanted, (list, tuple)):
            conditions.append(F.col(column).isin(list(wanted)))
        else:
            conditions.append(F.col(column) == wanted)
    return reduce(Column.__and__, conditions) if conditions else F.lit(True)


def _pass_key(total: Total | SeriesTotal, params: Mapping) -> tuple:
    """Totals with equal keys share one pass over their tables."""
    key = [type(total).__name__, total.table, total.key, repr(_bound(total.filters, params))]
    if isinstance(total, SeriesTotal):
        key += [total.series_table, total.series_key, total.series_value]
        key += [repr(_bound(total.series_filters, params)), repr(_dimension_key(total, params))]
    return tuple(key)


def _dimension_key(total: Total | SeriesTotal, params: Mapping) -> tuple | None:
    d = total.dimension
    return d and (d.table, d.fact_column, d.key_column, repr(_bound(d.filters, params)))


def _partners(tables: Tables, total: Total | SeriesTotal, params: Mapping) -> DataFrame:
    """Keys of the dimension that pass its filters, each once, with their number."""
    d = total.dimension
    rows = tables.table(d.table).filter(matches(d.filters, params))
    return rows.groupBy(F.col(d.key_column).alias("_partner")).agg(F.count(F.lit(1)).alias("_partners"))


def _members(total: Total | SeriesTotal) -> dict[str, list[str]]:
    """Components of each key value; without a key all rows are the member ``""``."""
    if total.key is None:
        return {"": list(total.members)}
    components: dict[str, list[str]] = {}
    for component, keys in total.members.items():
        for key in dict.fromkeys(keys):
            components.setdefault(str(key), []).append(component)
    return components


def _by_component(per_member: DataFrame, wanted: Sequence[Wanted], columns: Sequence[str]) -> DataFrame:
    """(total_id, component, total) rows; ``columns`` hold the sums of the wanted totals.

    A member may count for several components. The mapping is a literal, so the
    few summed rows need no join.
    """
    entries: dict[str, list[str]] = {}
    for (number, total, _), column in zip(wanted, columns, strict=True):
        for member, components in _members(total).items():
            entries.setdefault(member, []).extend(
                f"struct({number} AS total_id, {texts.quoted(c)} AS component, "
                f"{list(dict.fromkeys(columns)).index(column)} AS place, {float(total.divisor)!r}D AS divisor)"
                for c in components
            )
    if not entries:
        return per_member.selectExpr("0 AS total_id", "'' AS component", "0D AS total").limit(0)
    literal = ", ".join(f"{texts.quoted(m)}, array({', '.join(e)})" for m, e in entries.items())
    sums = ", ".join(f"`{c}`" for c in dict.fromkeys(columns))
    return per_member.selectExpr(f"inline(map({literal})[member])", f"array({sums}) AS sums").selectExpr(
        "total_id", "component", "sums[place] / divisor AS total"
    )


def _facts(tables: Tables, wanted: Sequence[Wanted]) -> DataFrame:
    """Rows of a pass: what passes the filters and belongs to any member, with ``member``."""
    _, first, params = wanted[0]
    facts = tables.table(first.table).filter(matches(first.filters, params))
    if first.key is None:
        return facts.withColumn("member", F.lit(""))
    keys = sorted({key for _, total, _ in wanted for members in total.members.values() for key in members})
    return facts.filter(F.col(first.key).isin(keys)).withColumn("member", F.col(first.key).cast("string"))


def _component_totals(tables: Tables, wanted: Sequence[Wanted]) -> DataFrame:
    """Totals of one pass. Facts are summed per member and dimension key before any join.

    Sums stay exact until they are added up per member, and the join only marks
    which keys have partners, so neither its strategy, the order of rows nor the
    other totals of the pass change a sum.
    """
    facts = _facts(tables, wanted)
    values = list(dict.fromkeys(total.value for _, total, _ in wanted))
    sides: dict[tuple, str] = {}
    for _, total, params in wanted:
        if total.dimension is not None:
            sides.setdefault(_dimension_key(total, params), f"_d{len(sides)}")
    fact_columns = {key: f"_f_{key[1]}" for key in sides}
    distinct = dict.fromkeys((key[1], name) for key, name in fact_columns.items())
    keyed = facts.select("member", *[F.col(c).alias(name) for c, name in distinct], *[F.col(f"`{v}`").alias(f"_v{i}") for i, v in enumerate(values)])
    sums = {f"_v{i}": F.col(f"_v{i}") for i in range(len(values))}
    summed = partial_sums(keyed, ["member", *[name for _, name in distinct]], sums)
    for _, total, params in wanted:
        key = _dimension_key(total, params)
        if key is not None and sides[key] not in summed.columns:
            partners = _partners(tables, total, params).select(
                F.col("_partner").alias(f"{sides[key]}_key"), F.lit(True).alias(sides[key])
            )
            how = "inner" if all(_dimension_key(t, p) == key for _, t, p in wanted) else "left"
            summed = summed.join(partners, F.col(fact_columns[key]) == F.col(f"{sides[key]}_key"), how)
    columns, counted = [], {}
    for _, total, params in wanted:
        key = _dimension_key(total, params)
        value, side = f"_v{values.index(total.value)}", "" if key is None else sides[key]
        columns.append(name := f"_sum{value}{side}")
        counted[name] = F.when(F.col(side), F.col(value)) if side else F.col(value)
    per_member = whole_sums(partial_sums(summed, ["member"], counted), ["member"], list(counted))
    per_member = per_member.select("member", *[F.col(c).cast("double").alias(c) for c in counted])
    return _by_component(per_member, wanted, columns)


def _series_totals(tables: Tables, wanted: Sequence[Wanted]) -> DataFrame:
    """Totals of one pass over facts and series; arrays never enter a shuffle.

    Each series is reduced to its sum and facts are counted per series, dimension
    key and member, before both sides meet. Sums stay exact up to the end.
    """
    _, first, params = wanted[0]
    facts = (
        _facts(tables, wanted)
        .groupBy(
            F.col(first.series_key).alias("_series"),
            F.col(first.dimension.fact_column).alias("_fact_key"),
            "member",
        )
        .agg(F.count(F.lit(1)).alias("_facts"))
    )
    series = tables.table(first.series_table).filter(matches(first.series_filters, params))
    series = series.select(
        F.col(first.series_key).alias("_key"), F.col(first.series_value).alias("_elements")
    )
    elements = series.select("_key", F.explode("_elements").alias("_sum"))
    reduced = partial_sums(elements, ["_key"], {"_sum": F.col("_sum")})
    joined = reduced.join(facts, F.col("_key") == F.col("_series"))
    per_key = partial_sums(joined, ["_fact_key", "member"], {"_sum": F.col("_sum")}, F.col("_facts"))
    matched = per_key.join(_partners(tables, first, params), F.col("_fact_key") == F.col("_partner"))
    per_member = partial_sums(matched, ["member"], {"_sum": F.col("_sum")}, F.col("_partners"))
    totals = whole_sums(per_member, ["member"], ["_sum"]).select("member", F.col("_sum").cast("double"))
    return _by_component(totals, wanted, ["_sum"] * len(wanted))


def planned_totals(
    tables: Tables, wanted: Sequence[Wanted]
) -> tuple[list[DataFrame], dict[int, str]]:
    """(total_id, component, total) frames of all wanted totals, and errors by number.

    Totals of the same table and filters share one pass. If one of them can't be
    planned, they are planned alone, so that the others are not affected.
    """
    passes: dict[tuple, list[Wanted]] = {}
    errors: dict[int, str] = {}
    for number, total, params in wanted:
        try:
            passes.setdefault(_pass_key(total, params), []).append((number, total, params))
        except Exception as problem:
            errors[number] = _first_line(problem)
    frames = []
    todo = list(passes.values())
    while todo:
        group = todo.pop(0)
        plan = _series_totals if isinstance(group[0][1], SeriesTotal) else _component_totals
        try:
            frames.append(plan(tables, group))
        except Exception as problem:
            if len(group) == 1:
                errors[group[0][0]] = _first_line(problem)
            else:
                todo += [[one] for one in group]
    return frames, errors


def _first_line(error: Exception) -> str:
    return (str(error) or type(error).__name__).splitlines()[0]
