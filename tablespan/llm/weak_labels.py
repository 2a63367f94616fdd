"""A quality classifier without gold labels.

Overlapping heuristics (LABELLERS) call a document good, bad, or abstain. Expectation-maximisation estimates how often
each is right from how they agree: the documents are counted by their pattern of votes, and every round computes the
posterior of "good" for each pattern and from it the share of good documents and each labeller's votes among good and
bad ones. The posteriors label documents for a linear scorer on hashed byte trigrams and binned statistics, which then
scores every document, also where all abstain.

Vote patterns number at most 3 ^ len(LABELLERS), whatever the data; they alone come to the driver, and counts cover all
documents. Statistics are computed once, and written with the texts. The scorer is fitted on at most about MAX_SAMPLE
documents, chosen by a hash of doc_id and text, in rounds: every task improves the weights on its rows, and the tasks'
weights are averaged. Weights are of fixed size.

Defined results: a null or empty text has the statistics of an empty text; repeated rows count each time, but the scorer
learns from one of them; rows of one doc_id with different texts are judged by their own texts; a null doc_id is a value
like others; without documents there is nothing to fit and no row; columns besides doc_id and text are
ignored. Ties at a score of 0.5 count as good.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablespan.llm.common import stage_table, text_blocks
from tablespan.llm.rules import FEATURES, text_stats
from tablespan.llm.shingles import mix, text_bytes

#: name -> (good if, bad if), over the columns of `rules.text_stats` and FEATURES.
LABELLERS = {
    "length": ("n_words >= 50", "n_words < 3"),
    "symbols": ("false", "symbols_per_word > 0.2"),
    "repetition": ("false", "repeated_words > 0.5"),
    "variety": ("distinct_words > 0.4 and n_words >= 50", "distinct_words < 0.25"),
    "lines": ("false", "repeated_lines > 0.4"),
    "case": ("false", "capitals_per_char > 0.3"),
    "words": ("mean_word between 3 and 9", "mean_word < 2 or mean_word > 14"),
}
#: P(vote bad, good, abstains) assumed at first for a bad and for a good document: complaints are rarely wrong, praise
#: says less. The assumption keeps the weight of PRIOR_SHARE of all documents.
ASSUMED = ((0.30, 0.35, 0.35), (0.01, 0.60, 0.39))
PRIOR_SHARE = 0.05
#: Bounds that keep classes apart although a bad document is usually bad in one way only: how often a labeller may
#: complain about good documents, and how much less often it may praise bad ones that it does not complain about.
MAX_WRONG, MIN_PRAISE = 0.001, 0.8
ROUNDS = 60
MAX_SAMPLE = 20_000
WEIGHTS = 1 << 16
BIN = 8
EPOCHS, RATE = 4, 2.0


def _vote(good: str, bad: str) -> Column:
    return F.when(F.expr(bad), 0).when(F.expr(good), 1).otherwise(2)


def votes(stats: DataFrame) -> Column:
    """All labellers' votes as one number: a digit 0 (bad), 1 (good) or 2 (abstains) each, to base 3."""
    code = F.lit(0)
    for good, bad in LABELLERS.values():
        code = code * 3 + _vote(good, bad)
    return code


def posteriors(counts: dict[int, int], labellers: int, rounds: int = ROUNDS) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of "good" by vote pattern, and P(vote | class) as an array (labeller, class, vote). Classes keep their
    meaning by the votes assumed of them (ASSUMED)."""
    codes = np.array(sorted(counts), np.int64)
    weight = np.array([counts[c] for c in codes], float)
    digits = (codes[:, None] // 3 ** np.arange(labellers - 1, -1, -1)) % 3
    chance = np.zeros((labellers, 2, 3))
    chance[:, 0], chance[:, 1] = ASSUMED
    prior = 0.7
    good = np.full(len(codes), prior)
    for _ in range(rounds if len(codes) else 0):
        by_class = np.log(chance[np.arange(labellers)[None, :], :, digits]).sum(axis=1)
        odds = by_class[:, 1] - by_class[:, 0] + np.log(prior) - np.log(1 - prior)
        good = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        prior = float(np.clip((weight * good).sum() / weight.sum(), 0.01, 0.99))
        for k in range(3):
            hit = digits == k
            for c, p in enumerate((1 - good, good)):
                chance[:, c, k] = (hit * (weight * p)[:, None]).sum(axis=0) + PRIOR_SHARE * weight.sum() * ASSUMED[c][k]
        chance /= chance.sum(axis=2, keepdims=True)
        wrong = np.minimum(chance[:, 1, 0], MAX_WRONG)
        chance[:, 1, 1:] *= ((1 - wrong) / (1 - chance[:, 1, 0]))[:, None]
        chance[:, 1, 0] = wrong
        silent = 1 - chance[:, 0, 0]            # bad documents it does not complain about
        praise = np.clip(chance[:, 0, 1], MIN_PRAISE * silent * chance[:, 1, 1] / (1 - wrong), silent)
        chance[:, 0, 1], chance[:, 0, 2] = praise, np.maximum(1e-6, silent - praise)
    return dict(zip(codes.tolist(), good.tolist())), chance


def _features(texts: pa.Array, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight numbers of all trigrams, and how many each text has; then those of the binned statistics per text."""
    body, at = text_bytes(texts)
    value = body.astype(np.uint64)
    grams = mix((value[:-2] << np.uint64(16)) | (value[1:-1] << np.uint64(8)) | value[2:]) if len(body) > 2 else np.empty(0, np.uint64)
    slot = (grams & np.uint64(WEIGHTS - 1)).astype(np.int64)
    edges = np.minimum(at, len(slot))
    shape = mix(bins.astype(np.uint64) * np.uint64(1024) + np.arange(bins.shape[1], dtype=np.uint64) + np.uint64(1 << 32))
    return slot, edges, (shape & np.uint64(WEIGHTS - 1)).astype(np.int64)


def _margins(weights: np.ndarray, slot, edges, shape) -> np.ndarray:
    """Mean trigram weight plus the weights of the statistics."""
    total = np.concatenate([[0.0], np.cumsum(weights[slot])])
    n = np.maximum(1, edges[1:] - edges[:-1])
    return (total[edges[1:]] - total[edges[:-1]]) / n * BIN + weights[shape].sum(axis=1)


def _improved(weights: np.ndarray, epoch: int):
    """One pass over a task's rows in small steps; gives the weights after it and the number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = weights.copy(), 0
        for batch in batches:
            bins = np.array(batch.column(1).to_pylist(), np.int64).reshape(batch.num_rows, -1)
            goal = batch.column(2).to_numpy()
            for a in range(0, batch.num_rows, 32):
                slot, edges, shape = _features(batch.column(0).slice(a, 32), bins[a:a + 32])
                error = goal[a:a + 32] - 1 / (1 + np.exp(-_margins(own, slot, edges, shape)))
                n = edges[1:] - edges[:-1]
                step = RATE / (1 + epoch) / len(error)
                own += step * np.bincount(slot[:edges[-1]], np.repeat(error * BIN / np.maximum(1, n), n), WEIGHTS)
                own += step * np.bincount(shape.ravel(), np.repeat(error, shape.shape[1]), WEIGHTS)
                seen += len(error)
        yield pa.record_batch([pa.array([seen]), pa.array([own.tobytes()], pa.binary())], names=["n", "weights"])

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, seen = np.zeros(WEIGHTS), 0
    for batch in batches:
        for n, w in zip(batch.column(0).to_pylist(), batch.column(1)):
            total, seen = total + n * np.frombuffer(w.as_py()), seen + n
    yield pa.record_batch([pa.array([seen]), pa.array([(total / max(1, seen)).tobytes()], pa.binary())], names=["n", "weights"])


def _bins() -> Column:
    """Every statistic on a coarse logarithmic scale."""
    return F.array(*[F.floor(F.log1p(F.greatest(F.expr(e), F.lit(0.0)) * 20) * 2).cast("int") for e in FEATURES.values()])


def classified(documents: DataFrame, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """doc_id, votes, posterior (of "good", from the votes alone), score (of the linear scorer, 0 to 1) and kept."""
    stats = text_stats(documents, "doc_id", "text").select("row.*", "*", *[F.expr(e).alias(f) for f, e in FEATURES.items() if f != "n_words"])
    rows = stage_table(stats.select("doc_id", "text", votes(stats).alias("votes"), _bins().alias("bins")), "votes")
    counts = {r.votes: r.n for r in rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, _ = posteriors(counts, len(LABELLERS))
    posterior = F.lit(0.5)
    if good:
        table = F.create_map(*[F.lit(x) for pair in good.items() for x in pair])
        posterior = table[F.col("votes")]
    share = min(1.0, max_sample / max(1, sum(counts.values())))
    chosen = F.pmod(F.xxhash64(F.lit(3), "doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = rows.filter(chosen).select("doc_id", "text", "bins", posterior.alias("goal"), F.xxhash64("text").alias("hash"))
    sample = stage_table(sample.dropDuplicates(["doc_id", "hash"]).select("text", "bins", "goal"), "sample")
    weights = np.zeros(WEIGHTS)
    for epoch in range(EPOCHS):
        found = sample.mapInArrow(_improved(weights, epoch), "n long, weights binary").repartition(1).mapInArrow(_averaged, "n long, weights binary").first()
        if found is not None:
            weights = np.frombuffer(bytes(found.weights))
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            bins = np.array(batch.column(2).to_pylist(), np.int64).reshape(batch.num_rows, -1)
            margin = _margins(shared.value, *_features(batch.column(1), bins))
            yield pa.record_batch([batch.column(0), batch.column(3), pa.array(1 / (1 + np.exp(-margin)))], names=["doc_id", "votes", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    out = rows.select("doc_id", "text", "bins", "votes").mapInArrow(scored, f"doc_id {kind}, votes int, score double")
    return out.select("doc_id", "votes", posterior.alias("posterior"), "score", (F.col("score") >= 0.5).alias("kept"))
