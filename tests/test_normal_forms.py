"""Keys of several columns, closures and normal forms, against looking at every set."""

import random
from itertools import chain, combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.operators import normal_forms as N
from recordloom.operators.normal_forms import Dependency

LETTERS = "abcde"


def dep(x, y):
    return Dependency(frozenset(x), y)


DEPENDENCIES = st.lists(st.tuples(st.sets(st.sampled_from(LETTERS), min_size=1, max_size=3), st.sampled_from(LETTERS)).map(lambda p: dep(*p)), max_size=8)


def subsets(names, least=1):
    return chain.from_iterable(combinations(names, n) for n in range(least, len(names) + 1))


def test_closure():
    known = [dep("a", "b"), dep("bc", "d"), dep("d", "e")]
    assert N.closure("a", known) == set("ab") and N.closure("ac", known) == set("abcde") and N.closure("", known) == set()


@settings(max_examples=150, deadline=None)
@given(DEPENDENCIES)
def test_a_minimal_cover_says_the_same_and_nothing_twice(known):
    cover = N.minimal_cover(known)
    for s in subsets(LETTERS):
        assert N.closure(s, cover) == N.closure(s, known)
    for d in cover:
        rest = [x for x in cover if x != d]
        assert d.dependent not in N.closure(d.determinant, rest)
        assert all(d.dependent not in N.closure(d.determinant - {c}, cover) for c in d.determinant if len(d.determinant) > 1)


def unique(rows, at):
    return len({tuple(r[i] for i in at) for r in rows}) == len(rows) and not any(r[i] is None for r in rows for i in at)


def holds(rows, x, y):
    return len({tuple(r[i] for i in x) for r in rows}) == len({(*(r[i] for i in x), r[y]) for r in rows})


@pytest.mark.parametrize("seed", range(4))
def test_keys_and_dependencies_of_random_rows(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(4), rng.choice("xyz"), rng.choice([1, 2, None]), i // 3, rng.randrange(3)) for i in range(12)]
    rows = [(*r[:4], r[0] % 2) for r in rows]
    df = spark.createDataFrame(rows, "a int, b string, c int, d int, e int")
    keys, n = N.minimal_keys(df, size=3)
    want = []
    for s in subsets(range(5)):
        if len(s) <= 3 and unique(rows, s) and not any(set(k) < set(s) for k in want):
            want.append(s)
    assert n == 12 and {frozenset(LETTERS[i] for i in s) for s in want} == set(keys)
    found = set(N.dependencies_of(df, size=2))
    for y in range(5):
        for x in subsets([i for i in range(5) if i != y and i != 2]):  # without the column that has NULL
            if len(x) <= 2:
                minimal = holds(rows, x, y) and not any(holds(rows, p, y) for p in subsets(x) if len(p) < len(x))
                assert (dep([LETTERS[i] for i in x], LETTERS[y]) in found) == minimal, (x, y)


def test_findings(spark):
    """Students' marks: the name hangs on a part of the key, the teacher's room on the teacher; one teacher, one course."""
    rows = [(s, c, f"student {s}", f"teacher {c % 3}", 10 + c % 3, (7 * s + 3 * c) % 5) for s in range(12) for c in range(6)]
    df = spark.createDataFrame(rows, "student int, course int, name string, teacher string, room int, mark int")
    got = {(r.normal_form, r.kind, r.determinant, r.dependent) for r in N.normal_form_findings(df, "marks").collect()}
    assert {("2NF", "partial", "course", "teacher"), ("2NF", "partial", "course", "room"), ("3NF", "transitive", "teacher", "room"),
            ("3NF", "transitive", "room", "teacher"), ("BCNF", "prime", "name", "student")} <= got
    assert all("mark" not in (d, y) for _, _, d, y in got)
    assert N.normal_form_findings(df, "marks").select("key").distinct().first()[0] == "course, name; student, course"
    assert N.highest_normal_form(N.normal_form_findings(df, "marks"), "marks").first().normal_form == "1NF"


def test_tables_without_key_rows_or_findings(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x int, y string")
    assert N.candidate_keys(twice).count() == 0
    assert {tuple(r) for r in N.normal_form_findings(twice, "t").collect()} == {("t", "3NF", "transitive", "x", "y", None), ("t", "3NF", "transitive", "y", "x", None)}
    assert N.candidate_keys(twice.limit(0)).count() == 0
    clean = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "x int, y string")
    assert [tuple(r) for r in N.candidate_keys(clean).collect()] == [("x", 1, 3)]
    assert tuple(N.highest_normal_form(N.normal_form_findings(clean, "t"), "t").first()) == ("t", "BCNF", 0)
    nulls = spark.createDataFrame([(1, None), (2, 1), (3, 2)], "x int, y int")
    assert [r.key for r in N.candidate_keys(nulls).collect()] == ["x"]


def test_partial_dependency_on_two_of_three_key_columns(spark):
    rows = [(a, b, c, a * 7 + b, (a + b * c) % 3) for a in range(3) for b in range(3) for c in range(4)]
    df = spark.createDataFrame(rows, "a int, b int, c int, ab int, z int")
    got = {(r.normal_form, r.determinant, r.dependent) for r in N.normal_form_findings(df.drop("ab").withColumn("q", (df["a"] + df["b"]) % 2), "t", key_size=3).collect()}
    assert ("2NF", "a, b", "q") in got


def test_many_sets_go_through_few_passes(spark, monkeypatch):
    monkeypatch.setattr(N, "SETS_PER_PASS", 3)
    df = spark.range(50).selectExpr("id % 5 AS a", "id % 7 AS b", "id % 3 AS c", "id DIV 10 AS d")
    rows = [tuple(r) for r in df.collect()]
    want = {frozenset("abcd"[i] for i in s) for s in subsets(range(4)) if len(s) <= 3 and unique(rows, s)}
    assert set(N.minimal_keys(df, size=3)[0]) == {k for k in want if not any(x < k for x in want)}
