"""The manifest against a plain tree, with superblocks of every number of rounds."""

from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tablespan.llm import merkle
from tests.llm.fixtures import SCHEMA, documents, rows


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    doc, text, lang, source, n = row
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def tree(nodes):
    """The top, and for every node its siblings on the way: (before, after) by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i - i % 3
            paths[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 3])))
        nodes = [h("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], paths


def expected(table, change):
    by_source = defaultdict(list)
    for r in table:
        by_source[r[3]].append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    found, tops = [], []
    for s in order:
        members = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        top, paths = tree([leaf(r) for r in members])
        tops.append(top)
        found.append(list(zip(members, paths)))
    root, upper = tree(tops)
    out = []
    for top, above, members in zip(tops, upper, found):
        for r, path in members:
            node = leaf(change(r))
            for before, after in path + above:
                node = h(before + node + after)
            out.append((r[0], leaf(r), top, root, h("".join(a + b for a, b in path + above)), node, node == root))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def change():
    return {"text": F.regexp_replace("text", "\n", "")}


def without_breaks(r):
    return (r[0], r[1] and r[1].replace("\n", ""), *r[2:])


def test_awkward_documents(spark):
    got = merkle.manifest(documents(spark, True), change())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found(got) == expected(rows(), without_breaks)


@pytest.mark.parametrize("height", [1, 2, 7])
@pytest.mark.parametrize("sources", [1, 5, 40])
def test_rounds_of_superblocks(spark, sources, height):
    """One source holds a third of the rows; sizes lie around powers of three."""
    table = [(i * 7 % 251, f"line {i}\nend" if i % 2 else f"line {i}", "en", None if i % 3 == 0 else f"é{i % sources}", i) for i in range(251)]
    df = spark.createDataFrame(table, SCHEMA)
    got = found(merkle.manifest(df, change(), height))
    assert got == expected(table, without_breaks)
    assert {r[6] for r in got} == {True, False} and all(r[6] == ("\n" not in t[1]) for r, t in zip(
        sorted(got), sorted(table)))


def test_small_tables(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    one = [(5, "x" * 20_000_000, None, None, None)]
    got = found(merkle.manifest(spark.createDataFrame(one, SCHEMA)))
    assert got == [(5, leaf(one[0]), leaf(one[0]), leaf(one[0]), h(""), leaf(one[0]), True)]
    same = [(1, "a", "en", "s", 1)] * 10
    assert found(merkle.manifest(spark.createDataFrame(same, SCHEMA))) == expected(same, lambda r: r)
