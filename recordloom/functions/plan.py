"""Small helpers over plans: compute a costly expression once, spread a small input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns computed exactly once per row.

    A plain projection may be copied into every later filter or lambda that uses it, so a
    JSON parse would run several times.  A one-element ``inline`` keeps it in place.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, inside one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def last_wins(pairs: Column) -> Column:
    """Entries ``(key, value)`` to a map in which a later entry replaces an earlier one."""

    def build(entries: Column) -> Column:
        def rare(names: Column) -> Column:
            return F.map_from_entries(
                F.filter(entries, lambda e, i: F.array_position(names, e["key"]) == F.size(entries) - i)
            )

        keys = F.transform(entries, lambda e: e["key"])
        return let(
            keys,
            lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), F.map_from_entries(entries)).otherwise(
                let(F.reverse(k), rare)
            ),
        )

    return let(pairs, build)


def distinct_keys(fields: Column) -> Column:
    """A parsed map in which a repeated key keeps its first place and its last value."""

    def merged(keys: Column) -> Column:
        values = F.map_values(fields)
        names = F.array_distinct(keys)
        backwards = F.reverse(keys)
        last = F.transform(
            names, lambda k: F.get(values, (F.size(keys) - F.array_position(backwards, k)).cast("int"))
        )
        return F.map_from_arrays(names, last)

    return F.when(F.size(F.array_distinct(F.map_keys(fields))) == F.size(fields), fields).otherwise(
        let(F.map_keys(fields), merged)
    )


# An input of fewer splits than this counts as small (2 GB at the default split size).
SMALL_SPLITS = 16
SPREAD_TO = 256


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input that arrives in fewer splits than there are cores, before costly
    parsing; an input of many splits is left as it lies.  Meant for plain scans."""
    cores = min(df.sparkSession.sparkContext.defaultParallelism, SPREAD_TO)
    return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, SMALL_SPLITS) else df
