"""Levels and depth-first numbers by pointer doubling, against plain Python."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tablespan.operators import hierarchy

SCHEMA = "id long, up long"


def plain(rows):
    """{id: (level, root, place)} of the nodes below roots, children by id."""
    below, ids = {}, {i for i, _ in rows}
    for i, up in rows:
        below.setdefault(up, []).append(i)
    out, stack = {}, [(r, 1, r) for r in sorted(below.get(None, []), reverse=True)]
    while stack:
        i, level, root = stack.pop()
        out[i] = (level, root, len(out) + 1)
        stack += [(c, level + 1, root) for c in sorted(below.get(i, []), reverse=True)]
    assert set(out) <= ids
    return out


def tree(kind, n=300):
    draw = random.Random(kind)
    parents = {"wide": lambda i: 0, "chain": lambda i: i - 1, "random": lambda i: draw.randrange(i), "forest": lambda i: draw.choice([None, draw.randrange(i)]),
               "comb": lambda i: i - 1 if i % 2 else max(0, i - 2)}[kind]
    names = draw.sample(range(10_000), n)
    rows = [(names[0], None)] + [(names[i], None if (p := parents(i)) is None else names[p]) for i in range(1, n)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("kind", ["wide", "chain", "random", "forest", "comb"])
def test_trees(spark, kind):
    rows = tree(kind)
    found, cyclic = hierarchy.levels(spark.createDataFrame(rows, SCHEMA), "id", "up")
    listed = hierarchy.depth_first(found, "id", "up", ["id"])
    assert {r.id: (r.level, r.root, r.listed_as) for r in listed.collect()} == plain(rows) and cyclic.isEmpty()


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(hierarchy, "count", lambda start: (rounds.append(k) or k for k in itertools.count(start)))
    n = 100_000
    chain = spark.range(n).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    found, cyclic = hierarchy.levels(chain, "id", "up")
    assert 16 < len(rounds) < 20
    assert found.where("level = id + 1 and root = 0").count() == n and cyclic.isEmpty()


def test_cycles_and_lost_parents(spark):
    rows = [(1, None), (2, 1), (3, 4), (4, 5), (5, 3), (6, 5), (7, 7), (8, 99), (9, 8), (10, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    found, cyclic = hierarchy.levels(df, "id", "up")
    assert {(r.id, r.level, r.root) for r in found.collect()} == {(1, 1, 1), (2, 2, 1), (10, 3, 1)}
    assert {r.id for r in cyclic.collect()} == {3, 4, 5, 6, 7}
    # with a root of its own choice a cycle is entered once; conditions prune children, not roots
    found, _ = hierarchy.levels(df, "id", "up", roots=F.col("id") == 4, child_condition=F.col("id") != 6)
    assert {(r.id, r.level) for r in found.collect()} == {(4, 1), (3, 2), (5, 3)}
    # a lost parent makes a root of the listing
    assert {r.id: r.listed_as for r in hierarchy.depth_first(df.where("id in (8, 9, 1)"), "id", "up", ["id"]).collect()} == {1: 1, 8: 2, 9: 3}


def test_empty(spark):
    found, cyclic = hierarchy.levels(spark.createDataFrame([], SCHEMA), "id", "up")
    assert found.count() == 0 and cyclic.count() == 0 and hierarchy.depth_first(found, "id", "up", ["id"]).count() == 0


@pytest.mark.parametrize("kind", ["wide", "chain", "random", "forest", "comb"])
def test_listing_of_levelled_trees(spark, kind):
    rows = tree(kind)
    found, _ = hierarchy.levels(spark.createDataFrame(rows, SCHEMA), "id", "up")
    listed = hierarchy.depth_first(found, "id", "up", ["id"], levelled=True)
    assert {r.id: (r.level, r.root, r.listed_as) for r in listed.collect()} == plain(rows)


@pytest.mark.parametrize("levelled", [True, False])
def test_the_tour_has_heads_of_paths_only(spark, monkeypatch, levelled):
    """Twenty threads of thirty, one of them with a fork: the tour's length goes by threads, not by their rows."""
    rows = [(100 * t + k, 100 * t + k - 1 if k else None) for t in range(20) for k in range(30)] + [(5000, 310), (5001, 5000)]
    found, _ = hierarchy.levels(spark.createDataFrame(rows, SCHEMA), "id", "up")
    sizes, whole = [], hierarchy.chained
    monkeypatch.setattr(hierarchy, "chained", lambda links: (sizes.append(links.count()), whole(links))[1])
    listed = hierarchy.depth_first(found, "id", "up", ["id"], levelled=levelled)
    assert {r.id: (r.level, r.root, r.listed_as) for r in listed.collect()} == plain(rows)
    assert sizes == [32 if levelled else len(rows), 2 * 22]
