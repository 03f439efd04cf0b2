"""Array shapes and maps as columns (R1-R12, A8, N1-N6). A grid is long: one row per cell, with index columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_count(dims: Column) -> Column:
    """The product of the dimensions."""
    return F.aggregate(dims, F.lit(1).cast("long"), lambda x, d: x * d)


def row_major(pos: Column, columns: Column | int) -> tuple[Column, Column]:
    """(i, j) of a position where the last index runs fastest."""
    c = F.lit(columns) if isinstance(columns, int) else columns
    return F.floor(pos / c).cast("int"), (pos % c).cast("int")


def column_major(pos: Column, *sizes: int) -> tuple[Column, ...]:
    """Indices of a position where the first index runs fastest."""
    out, rest = [], pos
    for n in sizes:
        out.append((rest % n).cast("int"))
        rest = F.floor(rest / n)
    return tuple(out)


def zipped(*columns: Column) -> Column:
    """Rows to columns and back."""
    return F.arrays_zip(*columns)


def transposed(matrix: Column) -> Column:
    """An array of rows as an array of columns."""
    width = F.size(F.element_at(matrix, 1))
    return F.when(F.size(matrix) > 0, F.transform(F.sequence(F.lit(0), width - 1), lambda j: F.transform(matrix, lambda row: row[j]))).otherwise(matrix)


def level_index(levels: Column, label: Column) -> Column:
    """The place of a level from 0; an error that lists the known ones otherwise."""
    at = F.array_position(levels, label)
    return F.when(at > 0, at - 1).otherwise(F.raise_error(F.concat(F.lit("unknown level "), label, F.lit(", known: "), sorted_levels(levels))).cast("long"))


def masked_add(values: Column, test: Callable[[Column], Column], amount: float) -> Column:
    """An amount added where a test holds."""
    return F.transform(values, lambda x: F.when(test(x), x + amount).otherwise(x))


def steps(start: int, stop: int, step: int) -> Column:
    """Start, start + step, ... below stop."""
    return F.sequence(F.lit(start), F.lit(stop - 1), F.lit(step))


def sorted_levels(levels: Column) -> Column:
    """The known levels for an error text."""
    return F.array_join(F.array_sort(levels), ", ")


def required_property(properties: Column, name: str) -> Column:
    """A property's value; an error where it is missing."""
    value = F.try_element_at(properties, F.lit(name))
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"no property {name}")).cast("string"))


def has_keys(properties: Column, names: list[str]) -> Column:
    """whether a map has all of the names."""
    return F.forall(F.array(*map(F.lit, names)), lambda n: F.map_contains_key(properties, n))


def mapped_where(values: Column, key_pattern: str, change: Callable[[Column], Column]) -> Column:
    """A map's values changed where the key matches."""
    return F.transform_values(values, lambda k, v: F.when(k.rlike(key_pattern), change(v)).otherwise(v))


def inverted(values: Column) -> Column:
    """Values to keys."""
    return F.map_from_arrays(F.map_values(values), F.map_keys(values))


def as_map(names: Column, values: Column) -> Column:
    """N3."""
    return F.map_from_arrays(names, values)
