"""A Merkle manifest of a dataset: one digest for all rows, and for each row a proof that it belongs to it.

Every row is a leaf. The leaves of a source, by doc_id, are hashed in runs of FAN until one node is left, its subroot;
the subroots, by source, are hashed the same way into the root. H is the sha256 of its inputs one after the other, in
lowercase hex, and digests enter H as that text.

Method: FAN ** LEVELS consecutive nodes of a tree are a superblock, so no task ever holds more than those of a tree, however
large a source is. Going up, each superblock is reduced to its top node, and the tops are the nodes of the next round;
after r rounds a tree has FAN ** (LEVELS * r) times fewer. Going down, the nodes of a superblock are cogrouped with the one
row of outer nodes they need, the siblings of its top on the way to the root, and one step in applyInPandas finishes the
reduction inside, joins the inner proof to the outer one, and at the leaves folds it. A lost executor repeats the
superblocks it had; rounds are tables in the shared folder.

Defined results: a null in any column is `-` inside its leaf, which no value can be mistaken for; a null source is the
first source, and a null doc_id the first of its source. Rows with the same doc_id are ordered by leaf; equal rows have
equal leaves at neighbouring places, so each has its own proof. An empty text is `0:`. A lone leaf is its source's subroot,
a lone subroot the root, and a row without any sibling has the digest of nothing as proof. An empty table gives no rows.
Other columns are ignored, whatever their names. Texts are hashed where they are scanned and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablespan.operators.ordinals import running_total
from tablespan.scratch import written_table

FAN = 3
#: A superblock has FAN ** LEVELS = 2 187 nodes.
LEVELS = 7
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]

_PATH = "tree string, pos long, left array<string>, right array<string>, subroot string, root string"


def leaf(values: dict[str, Column]) -> Column:
    """H of the values, each as its length in bytes, a colon and its text."""
    def entry(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[entry(values[c]) for c in COLUMNS]), 256)


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], at_most: int) -> list[list[str]]:
    """The nodes, and the nodes above them level by level until one is left or `at_most` levels are done."""
    out = [nodes]
    while len(out[-1]) > 1 and len(out) <= at_most:
        below = out[-1]
        out.append([_hash("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
    return out


def _full(nodes: list[str], levels: int) -> list[list[str]]:
    """`levels` levels above the nodes, runs of one included."""
    out = _levels(nodes, levels)
    while len(out) <= levels:
        out.append([_hash(out[-1][0])])
    return out


def _top(height: int, keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """The top of a superblock, both as one of several of its tree and as the only one."""
    nodes = group.sort_values("pos")["node"].tolist()
    alone = _levels(nodes, height)
    return pd.DataFrame({"tree": [keys[0]], "block": [keys[1]], "alone_levels": [len(alone) - 1], "alone": [alone[-1][0]],
                         "node": [_full(nodes, height)[-1][0]]})


def _by_block(nodes: DataFrame, height: int):
    return nodes.withColumn("block", F.expr(f"pos div {FAN ** height}")).groupBy("tree", "block")


def _climb(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The rounds over `nodes` (tree, pos, node), each a table (tree, block, levels, node) of superblock tops, until every
    tree has one. `levels` is `height`, but less for a superblock that is the whole tree."""
    rounds = []
    while True:
        tops = _by_block(nodes.select("tree", "pos", "node"), height).applyInPandas(
            lambda keys, group: _top(height, keys, group), "tree string, block long, alone_levels int, alone string, node string")
        tops = written_table(tops, "superblocks")
        several = tops.filter("block > 0").select("tree").distinct().withColumn("several", F.lit(True))
        rounds.append(written_table(tops.join(several, "tree", "left").selectExpr(
            "tree", "block", f"if(several, {height}, alone_levels) as levels", "if(several, node, alone) as node"), "superblocks"))
        if several.isEmpty():
            return rounds
        nodes = rounds[-1].withColumnRenamed("block", "pos")


def _paths(nodes: list[str], levels: int, outer: pd.Series) -> Iterable[tuple[list[str], list[str]]]:
    """For each node of a superblock the siblings to its left and right, joined, level by level up to the root."""
    rows = _full(nodes, levels)[:-1]
    above_left, above_right = list(outer["left"]), list(outer["right"])
    for i in range(len(nodes)):
        left, right = [], []
        for row in rows:
            run = i - i % FAN
            left.append("".join(row[run:i]))
            right.append("".join(row[i + 1:run + FAN]))
            i //= FAN
        yield left + above_left, right + above_right


def _with_paths(group: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one superblock with their paths to the root."""
    group, outer = group.sort_values("pos"), outer.iloc[0]
    nodes = group["node"].tolist()
    paths = list(_paths(nodes, int(outer["levels"]), outer))
    return group.assign(left=[p[0] for p in paths], right=[p[1] for p in paths], subroot=outer["subroot"],
                        root=outer["root"])


def fold(node: str, left: list[str], right: list[str]) -> str:
    """What a node and its siblings on the way up amount to."""
    for before, after in zip(left, right):
        node = _hash(before + node + after)
    return node


def _folded(group: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The leaves of one superblock with the digest of their proof, and what their present state folds to."""
    if not len(group):
        return pd.DataFrame(columns=_MANIFEST)
    rows = _with_paths(group, outer)
    rows["proof_sha256"] = [_hash("".join(a + b for a, b in zip(left, right))) for left, right in zip(rows["left"], rows["right"])]
    rows["folded_root"] = [fold(n, left, right) for n, left, right in zip(rows["present"], rows["left"], rows["right"])]
    return rows.rename(columns={"node": "leaf"})[_MANIFEST]


_MANIFEST = ["tree", "pos", "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]


def _descend(rounds: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """From the outer nodes of the last round's superblocks down to those of the first round's: rows (tree, block, levels, left,
    right, subroot, root). The tops of a round are the nodes of the round above it."""
    for below, above in zip(reversed(rounds[:-1]), reversed(rounds[1:])):
        known = outer.join(above.select("tree", "block", "levels"), ["tree", "block"])
        paths = _by_block(below.withColumnRenamed("block", "pos").select("tree", "pos", "node"), height).cogroup(
            known.groupBy("tree", "block")).applyInPandas(
                lambda group, outer: _with_paths(group, outer)[["tree", "pos", "left", "right", "subroot", "root"]], _PATH)
        outer = written_table(paths.withColumnRenamed("pos", "block"), "outer-nodes")
    return outer.join(rounds[0].select("tree", "block", "levels"), ["tree", "block"])


def manifest(documents: DataFrame, present: dict[str, Column] | None = None, height: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for each document. `present` gives columns whose
    state now differs from the manifest's: the leaf of that state is folded with the original's siblings, and the document
    is verified if the result is the root. Superblocks have FAN ** `height` nodes."""
    values = {c: F.col(c) for c in COLUMNS}
    leaves = documents.select(
        "doc_id", F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0")).alias("tree"),   # nulls first, then by bytes
        leaf(values).alias("node"), leaf({**values, **(present or {})}).alias("present"))
    placed = written_table(running_total(leaves, ["tree"], ["doc_id", "node"], "pos").withColumn("pos", F.col("pos") - 1), "leaves")
    rounds = _climb(placed, height)
    subroots = written_table(running_total(rounds[-1].select("tree", "node"), [], ["tree"], "pos")
                             .select(F.lit("").alias("tree"), (F.col("pos") - 1).alias("pos"), "node", F.col("tree").alias("source")), "subroots")
    upper = _climb(subroots, height)
    none = F.array().cast("array<string>")
    outer = _descend(upper, upper[-1].select(
        "tree", "block", none.alias("left"), none.alias("right"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root")), height)
    tops = _by_block(subroots, height).cogroup(outer.groupBy("tree", "block")).applyInPandas(
        lambda group, outer: _with_paths(group, outer).assign(tree=lambda rows: rows["source"], pos=0, subroot=lambda rows: rows["node"])[
            ["tree", "pos", "left", "right", "subroot", "root"]], _PATH)
    outer = _descend(rounds, written_table(tops.withColumnRenamed("pos", "block"), "outer-nodes"), height)
    found = _by_block(placed, height).cogroup(outer.groupBy("tree", "block")).applyInPandas(
        _folded, "tree string, pos long, doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))
