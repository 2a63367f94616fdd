"""Mixing sources to target weights by iterative proportional fitting.

`Targets` name a share of all tokens for categories of source, language and topic; what they do not name is one
category, OTHER, per dimension. The table of token counts by category is raked: its weights are scaled to each
dimension's targets in turn, again and again, SWEEPS times at least and until no margin is further than TOLERANCE from
its target. Where targets cannot be met together, or not within MAX_SWEEPS, a warning (`TargetsMissed`) names the
dimension, the category and the gap that is left. What comes out is one factor per category. A
document's probability is the product of its three factors, scaled so that the largest is 1: tokens of the sample meet
the targets in expectation, no document repeats, and no smaller sample is taken than needed.

The table has at most (named + 1) categories per dimension, a bound given by the parameters and not by the data; only
that table comes to the driver. Documents are drawn by a hash of doc_id, so a task that runs again draws the same.

Defined results: null or unnamed categories are OTHER; targets of categories without tokens are shared out among the
others in proportion; a null or empty text has no tokens and is drawn with its cell's probability, or, in a cell without
tokens, never; repeated rows share their fate, null doc_ids too; an empty table gives no rows. Columns may have any
names: sources and languages come from the columns `source` and `lang`, the topic is an expression of the caller.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablespan.llm.common import let

OTHER = "(other)"
SWEEPS, MAX_SWEEPS = 40, 10_000
#: Largest gap between a category's share of the tokens and its target.
TOLERANCE = 1e-6
DIMENSIONS = ("source", "lang", "topic")


class TargetsMissed(UserWarning):
    """Raking ended with margins that do not hold."""


@dataclass(frozen=True)
class Targets:
    """Shares of named categories; together below 1 in each dimension, where OTHER takes the rest."""
    source: dict[str, float] = field(default_factory=dict)
    lang: dict[str, float] = field(default_factory=dict)
    topic: dict[str, float] = field(default_factory=dict)

    def of(self, dimension: str) -> dict[str, float]:
        named = getattr(self, dimension)
        return {**named, OTHER: max(0.0, 1.0 - sum(named.values()))}


def n_tokens(text: Column) -> Column:
    """Token weight of a text: its words."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def text_form(words: Column, text: Column) -> Column:
    """A topic for tables that have none: the form of the text."""
    return F.when(F.contains(text, F.lit("License")), "licensed").when(words >= 600, "long").when(words >= 200, "medium").otherwise("short")


def _category(value: Column, targets: dict[str, float]) -> Column:
    named = [k for k in targets if k != OTHER]
    return F.when(value.isin(named), value).otherwise(OTHER) if named else F.lit(OTHER)


def raked(cells: dict[tuple[str, str, str], int], targets: Targets, sweeps: int = SWEEPS) -> dict[str, dict[str, float]]:
    """Factors by dimension and category such that count x factors has the target shares, within TOLERANCE after `sweeps`
    or more. Categories without tokens have no factor."""
    names = [list(targets.of(d)) for d in DIMENSIONS]
    counts = np.array([float(cells.get(c, 0)) for c in product(*names)]).reshape([len(n) for n in names])
    factors = [np.ones(len(n)) for n in names]
    if counts.sum() == 0:
        return {d: {} for d in DIMENSIONS}
    want = []
    for axis, (d, n) in enumerate(zip(DIMENSIONS, names)):
        there = counts.sum(axis=tuple(x for x in range(3) if x != axis)) > 0
        share = np.array([targets.of(d)[k] for k in n]) * there
        want.append(share / share.sum() if share.sum() > 0 else there / there.sum())

    def margin(axis):
        return np.einsum("abc,a,b,c->abc", counts, *factors).sum(axis=tuple(x for x in range(3) if x != axis))

    done, gap, before = 0, np.inf, np.inf
    # a gap that no longer shrinks belongs to targets that cannot be met together
    while done < sweeps or TOLERANCE < gap < before * (1 - 1e-7) and done < MAX_SWEEPS:
        for axis in range(3):
            now = margin(axis)
            factors[axis] = np.where(now > 0, factors[axis] * want[axis] / np.where(now > 0, now, 1), 0.0)
        done, before = done + 1, gap
        gaps = [np.abs(margin(axis) - want[axis]) for axis in range(3)]
        gap = max(float(g.max()) for g in gaps)
    if not gap <= TOLERANCE:
        axis = max(range(3), key=lambda x: gaps[x].max())
        warnings.warn(f"{DIMENSIONS[axis]} {names[axis][int(gaps[axis].argmax())]!r} misses its target share by {gap:.3g} "
                      f"after {done} sweeps", TargetsMissed, stacklevel=2)
    return {d: {k: float(f) for k, f, t in zip(n, factors[axis], want[axis])}
            for axis, (d, n) in enumerate(zip(DIMENSIONS, names))}


def _factor(category: Column, factors: dict[str, float]) -> Column:
    out = F.lit(0.0)
    for name, value in factors.items():
        out = F.when(category == name, F.lit(value)).otherwise(out)
    return out


def weighted(documents: DataFrame, targets: Targets, topic: Column | None = None) -> DataFrame:
    """row (a record of all columns), n_tokens, the three categories, probability, and drawn."""
    def measured(n: Column) -> Column:
        kind = text_form(n, F.col("text")) if topic is None else topic
        return F.struct(n.alias("n_tokens"), _category(kind, targets.of("topic")).alias("topic"))

    # words are counted once per row: a filter on what follows would otherwise repeat the count at every mention
    rows = documents.select(F.struct("*").alias("row"), let(n_tokens(F.col("text")), measured).alias("m"),
                            _category(F.col("source"), targets.of("source")).alias("source"),
                            _category(F.col("lang"), targets.of("lang")).alias("lang"))
    found = rows.groupBy("source", "lang", F.col("m.topic").alias("topic")).agg(F.sum("m.n_tokens").alias("n")).collect()
    cells = {(r.source, r.lang, r.topic): r.n for r in found if r.n}
    factors = raked(cells, targets)

    def weight(c):
        return np.prod([factors[d][k] for d, k in zip(DIMENSIONS, c)])

    most = max((weight(c) for c in cells), default=1.0) or 1.0
    probability = _factor(F.col("source"), factors["source"]) * _factor(F.col("lang"), factors["lang"]) * let(
        F.col("m"), lambda m: _factor(m["topic"], factors["topic"]))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("mix-"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")))), 1, 8), 16, 10)
    rows = rows.withColumn("probability", F.least(F.lit(1.0), probability / F.lit(float(most))))
    return rows.select("row", "m.n_tokens", "source", "lang", "m.topic", "probability",
                       (draw.cast("double") / float(1 << 32) < F.col("probability")).alias("drawn"))


def mixed(documents: DataFrame, targets: Targets, topic: Column | None = None) -> DataFrame:
    """The drawn documents, with the columns of `documents`."""
    return weighted(documents, targets, topic).filter("drawn").select("row.*")
