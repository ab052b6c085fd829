"""List functions as Column expressions: slices as in JavaScript, sets in order, and a list library."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slice_list(items: Column, start: Column, end: Column | None) -> Column:
    n = F.size(items)
    place = lambda k: F.when(k < 0, F.greatest(n + k, F.lit(0))).otherwise(F.least(k, n))
    a, b = place(start), n if end is None else place(end)
    return F.slice(items, a + 1, F.greatest(b - a, F.lit(0)))


def to_set(items: Column) -> Column:
    return F.array_sort(F.array_distinct(items))


def union(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))


def intersection(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_intersect(a, b))


def difference(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_except(a, b))


def total(items: Column) -> Column:
    return F.aggregate(F.transform(items, lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x)


# the list library
def peek(items: Column) -> Column:
    return F.get(items, F.lit(0))


def push(items: Column, x: Column) -> Column:
    return F.array_prepend(items, x)


def pop(items: Column) -> Column:
    return F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0)))


def append(items: Column, x: Column) -> Column:
    return F.array_append(items, x)


def insert(items: Column, at: int, x: Column) -> Column:
    return F.array_insert(items, F.lit(at + 1), x)


def drop(items: Column, at: int) -> Column:
    return F.filter(items, lambda _, i: i != at)


def clear(items: Column) -> Column:
    return F.slice(items, 1, 0)


def swap(items: Column, i: int, j: int) -> Column:
    return F.transform(items, lambda x, k: F.when(k == i, F.get(items, F.lit(j))).when(k == j, F.get(items, F.lit(i))).otherwise(x))


def reverse(items: Column) -> Column:
    return F.reverse(items)


def is_empty(items: Column) -> Column:
    return F.size(items) == 0
