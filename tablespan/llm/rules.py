"""Quality rules as a learned decision list, in DataFrame expressions only.

`text_stats` computes statistics of whole texts. Fixed base rules fail some texts. For the rest, sequential covering
learns an ordered list from labelled documents: a rule is a conjunction of thresholds on statistics, grown by
information gain on two thirds of the labelled rows, pruned on the other third, kept if precise enough there, and the
rows it covers leave before the next rule grows. Every value of the rows still covered is tried as a threshold, so a
bad kind is found however rare, from MIN_COVER rows on. A rule that pruning refuses gives way to the one that grows from
the next best statistic and side; the list ends when all are refused. `verdict` emits the list as one ordered
conditional expression.

What reaches the driver is one row per statistic and side. Labelled rows beyond MAX_LABELLED are
thinned by a hash of doc_id before fitting, the only bounded sample here; statistics and verdicts cover every document.

Defined results: a null or empty text has no words and fails the base rules; the unit of "word" is a run of characters
other than ASCII white space; repeated rows are judged one by one; null labels teach nothing; a document with several
labels teaches each of them; without labels the list is empty and the base rules alone decide; columns besides doc_id
and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablespan.llm.common import let, stage_table

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50

MAX_LABELLED = 40_000      # expected number of labelled rows used for fitting
MAX_TERMS = 4              # conditions of one rule
MIN_COVER = 3              # labelled rows that a rule must reject, on the growing and on the pruning rows
MIN_PRECISION = 0.95       # share of those that are labelled bad

#: Scale-free statistics the rules may use, from the columns of `text_stats`.
FEATURES = {
    "n_words": "cast(n_words as double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "digits_per_char": "n_digits / greatest(word_chars, 1)",
    "capitals_per_char": "n_capitals / greatest(word_chars, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "distinct_words": "n_distinct_words / greatest(n_words, 1)",
    "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeated_window_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice. Windows are compared by a 64-bit hash within one
    text; positions of repeated windows, sorted, cover 3 words for the first and at most 3 more for each next one."""
    def window(i):
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def covered(at: Column) -> Column:
        steps = F.zip_with(F.slice(at, 2, F.size(at) - 1), F.slice(at, 1, F.size(at) - 1), lambda b, a: F.least(b - a, F.lit(3)))
        return F.when(F.size(at) == 0, 0).otherwise(3 + F.aggregate(steps, F.lit(0), lambda s, x: s + x))

    def repeats(placed: Column) -> Column:
        def same(i, j):
            return F.get(placed, i)["h"] == F.get(placed, j)["h"]

        hit = F.filter(placed, lambda x, j: F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)))
        return let(F.array_sort(F.transform(hit, lambda x: x["i"])), covered)

    def by_hash(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(placed, repeats))

    starts = F.sequence(F.lit(0), F.size(words) - 3)
    return F.when(F.size(words) < 4, 0).otherwise(let(F.transform(starts, window), by_hash)).cast("long")


def text_stats(documents: DataFrame, *carried: str) -> DataFrame:
    """The carried columns and the statistics of the whole text, one row per row."""
    text = F.coalesce("text", F.lit(""))
    plain = F.translate(text, WHITE[1:], " " * (len(WHITE) - 1))
    words = F.filter(F.split(plain, " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(_without(line, WHITE)) > 0)
    capitals = F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
                        _repeated_window_words(w).alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"),
                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    rows = documents.select(
        F.struct(*carried).alias("row"), let(words, of_words).alias("w"), let(lines, of_lines).alias("l"),
        F.length(_without(text, WHITE)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(_without(text, "!?.,;:"))).cast("long").alias("n_marks"),
        (F.length(text) - F.length(_without(text, "0123456789"))).cast("long").alias("n_digits"),
        capitals.cast("long").alias("n_capitals"))
    return rows.select("row", "w.*", "l.*", "word_chars", "n_symbols", "n_marks", "n_digits", "n_capitals")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Term:
    """`feature` at most `limit`, or above it."""
    feature: str
    limit: float
    above: bool

    def expr(self) -> Column:
        return self.on(F.expr(FEATURES[self.feature]))

    def on(self, value: Column) -> Column:
        return value > F.lit(self.limit) if self.above else value <= F.lit(self.limit)


Rule = tuple[Term, ...]


def verdict(rules: list[Rule]) -> Column:
    """The decision list over the columns of `text_stats`: the first rule that holds rejects."""
    out = None
    for rule in rules:
        holds = _all([t.expr() for t in rule])
        out = F.when(holds, False) if out is None else out.when(holds, False)
    return F.lit(True) if out is None else out.otherwise(True)


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def learn_rules(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Ordered rules that reject documents like those with quality 0, from `labels` (doc_id, quality) of documents
    that pass the base rules."""
    known = labels.filter("quality in (0, 1) and doc_id is not null").select("doc_id", (F.col("quality") == 0).cast("int").alias("bad"))
    n = known.count()
    if n == 0:
        return []
    if n > max_labelled:
        share = max_labelled / n
        known = known.filter(F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    known = stage_table(known, "labels")
    if known.count() <= 2 * max_labelled:   # a doc_id with many labels could make more
        known = F.broadcast(known)
    # written first: else the filter on statistics moves below the join, to all documents
    texts = stage_table(documents.select("doc_id", "text").join(known, "doc_id"), "labelled-texts")
    rows = text_stats(texts, "doc_id", "bad").filter(~base_failed()).select(
        "row.bad", (F.pmod(F.xxhash64(F.lit(2), "row.doc_id"), F.lit(3)) < 2).alias("grow"),
        *[F.expr(e).alias(f) for f, e in FEATURES.items()])
    rows = stage_table(rows, "labelled")
    rules: list[Rule] = []
    left = F.lit(True)
    while True:      # every rule takes MIN_COVER rows or more away
        growing, pruning = rows.filter(left & F.col("grow")), rows.filter(left & ~F.col("grow"))
        for first in _splits(growing):
            terms = _prune(pruning, _grow(growing, first))
            if terms:
                break
        else:
            break
        rules.append(_centred(growing, terms))
        left = left & ~_holds(rules[-1])    # as emitted: what its moved limits leave out may still be learned
    return rules


def _holds(terms: list[Term] | Rule) -> Column:
    """All terms, over columns named as the statistics."""
    return _all([t.on(F.col(t.feature)) for t in terms])


def _splits(rows: DataFrame) -> list[Term]:
    """Of each statistic and side the limit, between two values of the rows, with the largest information gain; the best
    first, those without gain left out."""
    values = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES])
    counts = rows.select("bad", F.inline(values)).groupBy("feature", "value").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("feature")
    upto = whole.orderBy("value")
    limits = counts.select("feature", ((F.col("value") + F.lead("value").over(upto)) / 2).alias("limit"),
                           F.sum("bad").over(upto).alias("p"), F.sum("n").over(upto).alias("t"),
                           F.sum("bad").over(whole).alias("bad"), F.sum("n").over(whole).alias("n")).filter("limit is not null")
    sides = F.array(F.struct(F.lit(False).alias("above"), F.col("p"), F.col("t")),
                    F.struct(F.lit(True).alias("above"), (F.col("bad") - F.col("p")).alias("p"), (F.col("n") - F.col("t")).alias("t")))
    gain = F.expr("p * (log2(p / t) - log2(bad / n))")
    best = limits.select("feature", "limit", "bad", "n", F.inline(sides)).filter(F.col("p") >= MIN_COVER).groupBy("feature", "above").agg(
        F.max(F.struct(gain.alias("gain"), "limit")).alias("best")).filter("best.gain > 1e-9").collect()
    return [Term(r.feature, r.best.limit, r.above) for r in sorted(best, key=lambda r: (-r.best.gain, r.feature, r.above))]


def _grow(rows: DataFrame, first: Term) -> list[Term]:
    """Terms added one by one, each with the largest information gain over the growing rows still covered."""
    terms = [first]
    while len(terms) < MAX_TERMS:
        found = _splits(rows.filter(_holds(terms)))
        if not found:
            break
        terms.append(found[0])
    return terms


def _prune(rows: DataFrame, terms: list[Term]) -> list[Term]:
    """The shortest prefix of the terms that is best on the pruning rows, or none if it is not precise enough."""
    prefixes = [_holds(terms[:k + 1]) for k in range(len(terms))]
    found = rows.agg(*[F.sum(F.when(c, F.col("bad"))).alias(f"p{k}") for k, c in enumerate(prefixes)],
                     *[F.sum(c.cast("int")).alias(f"n{k}") for k, c in enumerate(prefixes)]).first()
    scored = [((2 * (found[f"p{k}"] or 0) - (found[f"n{k}"] or 0)) / max(1, found[f"n{k}"] or 0), -k) for k in range(len(terms))]
    _, k = max(scored)
    p, n = found[f"p{-k}"] or 0, found[f"n{-k}"] or 0
    return terms[:1 - k] if p >= MIN_COVER and p >= MIN_PRECISION * n else []


def _centred(rows: DataFrame, terms: list[Term]) -> Rule:
    """The terms with each limit moved halfway towards the bad rows it covers (all but the nearest twentieth of them),
    so that a clean document just beyond the clean ones seen is not rejected."""
    bad = rows.filter((F.col("bad") == 1) & _holds(terms))
    edge = bad.agg(*[F.percentile(t.feature, F.lit(0.05 if t.above else 0.95)).alias(f"e{k}") for k, t in enumerate(terms)]).first()
    return tuple(Term(t.feature, t.limit if edge[k] is None else (t.limit + edge[k]) / 2, t.above) for k, t in enumerate(terms))


def judged(documents: DataFrame, labels: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """For every document `row` (a record of the carried columns, doc_id if none are named), its statistics,
    base_failed and kept."""
    rules = learn_rules(documents, labels)
    kept = F.when(base_failed(), False).otherwise(verdict(rules))
    return text_stats(documents, *(carried or ["doc_id"])).select("*", base_failed().alias("base_failed"), kept.alias("kept"))
