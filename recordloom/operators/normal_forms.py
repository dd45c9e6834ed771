"""Keys of several columns, closures of dependencies, and findings against the second, third and Boyce-Codd normal form.

What is counted comes from Spark jobs over all rows; what is derived from the counts (closures, covers, findings) is bounded by
the columns and done beside them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import column_type_name
from .design import functional_dependencies

#: Relative deviation of the sketches; a set further than MARGIN from what is asked is settled by its sketch.
SKETCH_ERROR = 0.02
MARGIN = 5 * SKETCH_ERROR
#: So many sets are sketched in one pass.
SETS_PER_PASS = 200

Set = frozenset[str]


class Dependency(NamedTuple):
    determinant: Set
    dependent: str


def _columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return list(columns) if columns is not None else [
        f.name for f in df.schema.fields if column_type_name(f.dataType) not in ("dict", "list")]


def _value(columns: Iterable[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def _digest(columns: Sequence[str]) -> list[Column]:
    """128 bits of the columns' values; NULL is a value of its own, and no value runs into its neighbour."""
    parts = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast("string"))]
    back = [x for c in columns for x in (F.reverse(F.col(f"`{c}`").cast("string")), F.col(f"`{c}`").isNull())]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *back)]


def sketched_counts(df: DataFrame, sets: Sequence[Sequence[str]]) -> list[int]:
    """Estimated numbers of distinct values of column sets: one aggregate for many sets, and no row is copied."""
    out: list[int] = []
    for at in range(0, len(sets), SETS_PER_PASS):
        part = sets[at:at + SETS_PER_PASS]
        out += list(df.agg(*[F.approx_count_distinct(_value(s), SKETCH_ERROR).alias(f"s{i}") for i, s in enumerate(part)]).first())
    return out


def is_unique(df: DataFrame, columns: Sequence[str]) -> bool:
    """No two rows agree in the columns: digests are counted, combined before the shuffle."""
    a, b = _digest(columns)
    return df.groupBy(a.alias("a"), b.alias("b")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def determined(df: DataFrame, determinant: Sequence[str], dependents: Sequence[str]) -> list[str]:
    """Those of ``dependents`` that have one value (NULL included) for each value of ``determinant``, in one shuffle of one row a value and task."""
    spread = []
    for i, c in enumerate(dependents):
        for k, d in enumerate(_digest([c])):
            spread += [F.min(d).alias(f"l{i}_{k}"), F.max(d).alias(f"h{i}_{k}")]
    groups = df.groupBy(*[F.col(f"`{c}`") for c in determinant]).agg(*spread)
    same = [F.bool_and((F.col(f"l{i}_0") == F.col(f"h{i}_0")) & (F.col(f"l{i}_1") == F.col(f"h{i}_1"))).alias(f"d{i}") for i in range(len(dependents))]
    row = groups.agg(*same).first()
    return [c for c, holds in zip(dependents, row, strict=True) if holds is not False]


def minimal_keys(df: DataFrame, columns: Sequence[str] | None = None, size: int = 2) -> tuple[list[Set], int]:
    """All minimal keys of up to ``size`` columns, and the number of rows.

    Level by level: a set that holds a key is not looked at; one whose columns' distinct counts cannot multiply to the number of rows, or whose
    sketch stays below it, is settled; what is left is counted exactly.  A column with NULL is in no key.
    """
    names = _columns(df, columns)
    facts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(names)],
                   *[F.approx_count_distinct(F.col(f"`{c}`"), SKETCH_ERROR).alias(f"d{i}") for i, c in enumerate(names)]).first()
    rows = facts["rows"]
    counts: dict[Set, int] = {frozenset([c]): facts[f"d{i}"] for i, c in enumerate(names) if facts[f"n{i}"] == rows}
    keys: list[Set] = []
    if not rows:
        return keys, 0
    least = rows * (1 - MARGIN)
    level = list(counts)
    for width in range(1, size + 1):
        if width > 1:
            full = [c for c in names if frozenset([c]) in counts]
            level = [s for s in map(frozenset, combinations(full, width)) if not any(k <= s for k in keys)]
            # A set has at most as many values as a part of it times the rest.
            level = [s for s in level if min((counts[s - {c}] * counts[frozenset([c])] for c in s if s - {c} in counts), default=rows) * (1 + MARGIN) ** 2 >= rows]
            counts.update(zip(level, sketched_counts(df, [_in_order(s, names) for s in level]), strict=True))
        keys += [s for s in level if counts[s] >= least and is_unique(df, _in_order(s, names))]
    return keys, rows


def _in_order(columns: Set, names: Sequence[str]) -> list[str]:
    return [c for c in names if c in columns]


def candidate_keys(df: DataFrame, columns: Sequence[str] | None = None, size: int = 2) -> DataFrame:
    """``(key, size, rows)``: every minimal key of up to ``size`` columns."""
    names = _columns(df, columns)
    keys, rows = minimal_keys(df, names, size)
    return df.sparkSession.createDataFrame([(", ".join(_in_order(k, names)), len(k), rows) for k in keys], "key string, size int, rows bigint")


def closure(attributes: Iterable[str], dependencies: Iterable[Dependency]) -> Set:
    """All attributes that the given ones determine: dependencies are applied until none adds one."""
    known, open_ = set(attributes), list(dependencies)
    while True:
        usable = [d for d in open_ if d.determinant <= known]
        if not usable:
            return frozenset(known)
        known |= {d.dependent for d in usable}
        open_ = [d for d in open_ if d.dependent not in known]


def minimal_cover(dependencies: Iterable[Dependency]) -> list[Dependency]:
    """Dependencies with the same closures of which none, and no part of a determinant, can be left out.  Wide determinants go first."""
    order = lambda d: (-len(d.determinant), sorted(d.determinant), d.dependent)
    cover = sorted({d for d in dependencies if d.dependent not in d.determinant}, key=order)
    for i, d in enumerate(cover):
        for c in sorted(d.determinant):
            smaller = cover[i].determinant - {c}
            if smaller and d.dependent in closure(smaller, cover):
                cover[i] = Dependency(smaller, d.dependent)
    for d in sorted(set(cover), key=order):
        rest = [x for x in cover if x != d]
        if d.dependent in closure(d.determinant, rest):
            cover = rest
    return sorted(set(cover), key=order, reverse=True)


def dependencies_of(df: DataFrame, columns: Sequence[str] | None = None, size: int = 1, also: Iterable[Set] = ()) -> list[Dependency]:
    """All minimal dependencies whose determinant has up to ``size`` columns, and those of the sets in ``also``.

    Single columns come from the pairwise analysis.  A wider set X determines Y if X and Y have as many values together as X alone:
    sketches settle most of them, and the open ones of a set are compared in one shuffle.
    """
    names = _columns(df, columns)
    found = [Dependency(frozenset([r.determinant]), r.dependent)
             for r in functional_dependencies(df, names).select("determinant", "dependent").collect()]  # at most columns squared
    wanted = {s for s in also if len(s) > 1} | {frozenset(s) for width in range(2, size + 1) for s in combinations(names, width)}
    for width in range(2, max(map(len, wanted), default=1) + 1):
        sets = [s for s in sorted(wanted, key=sorted) if len(s) == width]
        # What a part determines, the whole does, and that is not minimal.
        asked = {s: [c for c in names if c not in s and not any(d.dependent == c and d.determinant < s for d in found)] for s in sets}
        sketches = [s for s in sets if asked[s]]
        flat = [_in_order(s, names) for s in sketches] + [[*_in_order(s, names), c] for s in sketches for c in asked[s]]
        counts = sketched_counts(df, flat)
        alone, together = counts[:len(sketches)], iter(counts[len(sketches):])
        for s, n in zip(sketches, alone, strict=True):
            open_ = [c for c, both in [(c, next(together)) for c in asked[s]] if both <= n * (1 + 2 * MARGIN)]
            if open_:
                found += [Dependency(s, c) for c in determined(df, _in_order(s, names), open_)]
    return found


def violations(dependencies: Iterable[Dependency], keys: Sequence[Set]) -> list[tuple[str, str, Dependency]]:
    """(normal form, kind, dependency) for each dependency that breaks one.

    On a proper part of a key a non-prime attribute is ``partial`` (2NF), on another set that is no superkey ``transitive``
    (3NF); a prime attribute that depends on no superkey breaks Boyce-Codd form only.  Attributes of keys are prime.
    """
    dependencies = list(dependencies)
    prime = frozenset().union(*keys)
    out = []
    for d in dependencies:
        if any(k <= closure(d.determinant, dependencies) for k in keys):
            continue
        if d.dependent in prime:
            out.append(("BCNF", "prime", d))
        elif any(d.determinant < k for k in keys):
            out.append(("2NF", "partial", d))
        else:
            out.append(("3NF", "transitive", d))
    return out


def normal_form_findings(df: DataFrame, entity: str, columns: Sequence[str] | None = None, key_size: int = 2, size: int = 1) -> DataFrame:
    """``(entity, normal_form, kind, determinant, dependent, key)``: what the rows of a table hold against normal forms.

    Keys of up to ``key_size`` columns; determinants of up to ``size`` columns, and every proper part of a key.  ``key`` lists the keys (NULL
    where there is none of that size: then no attribute is prime and every dependency is a finding), and ``determinant`` its columns in table order.
    """
    names = _columns(df, columns)
    keys, _ = minimal_keys(df, names, key_size)
    parts = {frozenset(p) for k in keys for width in range(1, len(k)) for p in combinations(k, width)}
    broken = violations(dependencies_of(df, names, size, parts), keys)
    listed = "; ".join(sorted(", ".join(_in_order(k, names)) for k in keys)) or None
    rows = [(entity, form, kind, ", ".join(_in_order(d.determinant, names)), d.dependent, listed) for form, kind, d in broken]
    return df.sparkSession.createDataFrame(rows, "entity string, normal_form string, kind string, determinant string, dependent string, key string")


def highest_normal_form(findings: DataFrame, entity: str) -> DataFrame:
    """``(entity, normal_form, findings)``: the highest form that nothing speaks against."""
    has = lambda form: F.count_if(F.col("normal_form") == form) > 0
    return findings.agg(
        F.lit(entity).alias("entity"),
        F.when(has("2NF"), "1NF").when(has("3NF"), "2NF").when(has("BCNF"), "3NF").otherwise("BCNF").alias("normal_form"),
        F.count(F.lit(1)).alias("findings"))
