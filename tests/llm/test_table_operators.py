import datetime as dt
import hashlib

import numpy as np
import pytest

from tablespan.llm import chat, impacts, mixing, url_lists
from tablespan.llm.components import components
from tests.llm.fixtures import SCHEMA, documents


def test_chat_round_trip(spark):
    turns = [(1, 0, "user", "hi <|end|> </s>"), (1, 1, "assistant", r"<\|turn|> [INST] \ "), (1, 2, "user", None), (1, 3, "assistant", ""),
             (1, 4, "assistant", "é" * 5), (2, None, None, "only"), (None, 1, "assistant", "x"), (3, 1, "user", "a"), (3, 1, "user", "a"),
             (4, 5, "user<|text|>", "[/INST]")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' as pos", "1 as piece")
    formatted = chat.formatted_turns(table)
    found = {r.conv_id: r for r in chat.digests(formatted).collect()}
    for conv in {t[0] for t in turns}:
        own = [t for t in turns if t[0] == conv]
        whole = "".join((t[2] or "") + "\n" + (t[3] or "") + "\n" for t in own)
        replies = "".join(t[3] or "" for t in own if t[2] == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(replies), hashlib.sha256(replies.encode()).hexdigest())
    full = {(r.conv_id, r.pos): r for r in chat.with_context(formatted).collect()}
    stream = {r.conv_id: r.stream for r in chat.streams(formatted).collect()}
    assert sorted(p for c, p in full if c == 1) == [1, 3, 4] and found[1].n_examples == 3
    for (conv, _), r in full.items():
        assert stream[conv].startswith(r.context + r.reply)
        assert (r.context + r.reply)[r.loss_end:] == chat.END
    assert found[1].expanded_chars == sum(len(r.context + r.reply) for (c, _), r in full.items() if c == 1)
    assert chat.digests(chat.formatted_turns(table.limit(0))).count() == 0


@pytest.mark.parametrize("share_chars", [1 << 28, 300])
def test_chat_examples_hold_their_contexts(spark, monkeypatch, share_chars):
    monkeypatch.setattr(chat, "SHARE_CHARS", share_chars)
    turns = [(c, k, "assistant" if k % 2 else "user", f"é{c}.{k} </s>") for c in (1, None) for k in range(12)] + [(2, 0, "user", "a")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat.formatted_turns(table)
    piece = lambda t: f"<|turn|>{t[2]}<|text|>{t[3].replace('</s>', '<' + chr(92) + '/s>')}<|end|>"
    found = {(r.conv_id, r.pos): (r.context, r.reply) for r in chat.expand_targets(formatted).collect()}
    assert found == {(c, k): ("".join(piece(t) for t in turns if t[0] == c and t[1] < k), piece(next(t for t in turns if t[:2] == (c, k))))
                     for c in (1, None) for k in range(1, 12, 2)}
    chars = {r.conv_id: (r.n_examples, r.expanded_chars) for r in chat.digests(formatted).collect()}
    assert chars == {2: (0, 0), **{c: (6, sum(len(x + y) for (d, _), (x, y) in found.items() if d == c)) for c in (1, None)}}


def test_mixing_meets_targets(spark):
    targets = mixing.Targets(source={"src0": 0.2, "gone": 0.3}, lang={"en": 0.5}, topic={})
    cells = {(s, x, mixing.OTHER): n for s, x, n in (("src0", "en", 500), ("src0", mixing.OTHER, 100), (mixing.OTHER, "en", 200),
                                                     (mixing.OTHER, mixing.OTHER, 400))}
    f = mixing.raked(cells, targets)
    weight = {c: n * f["source"][c[0]] * f["lang"][c[1]] * f["topic"][c[2]] for c, n in cells.items()}
    total = sum(weight.values())
    assert abs(sum(w for c, w in weight.items() if c[0] == "src0") / total - 0.2 / 0.7) < 1e-6
    assert abs(sum(w for c, w in weight.items() if c[1] == "en") / total - 0.5) < 1e-6
    docs = documents(spark, True)
    kept = mixing.mixed(docs, targets)
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    assert mixing.mixed(spark.createDataFrame([], SCHEMA), targets).count() == 0
    assert mixing.mixed(docs.filter("text is null"), targets).count() == 0


def test_raking_goes_on_until_the_margins_hold():
    other = mixing.OTHER
    cells = {("src0", "en", other): 1_000_000, ("src0", other, other): 100, (other, "en", other): 100, (other, other, other): 1_000_000}
    targets = mixing.Targets(source={"src0": 0.5}, lang={"en": 0.495})
    f = mixing.raked(cells, targets)
    weight = {c: n * f["source"][c[0]] * f["lang"][c[1]] * f["topic"][c[2]] for c, n in cells.items()}
    assert abs(sum(w for c, w in weight.items() if c[0] == "src0") - 0.5) < 2e-6
    assert abs(sum(w for c, w in weight.items() if c[1] == "en") - 0.495) < 2e-6


def test_targets_that_cannot_be_met_are_reported():
    cells = {("src0", "en", mixing.OTHER): 10, (mixing.OTHER, mixing.OTHER, mixing.OTHER): 10}
    with pytest.warns(mixing.TargetsMissed):
        mixing.raked(cells, mixing.Targets(source={"src0": 0.5}, lang={"en": 0.3}))


def test_probabilities_give_the_shares(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('w ', 20) as text", "if(id % 10 < 7, 'src0', 'src1') as source",
                                        "if(id % 3 = 0, 'en', 'de') as lang")
    kept = mixing.mixed(docs, mixing.Targets(source={"src0": 0.5}, lang={"en": 0.5}))
    n = kept.count()
    assert abs(kept.filter("source = 'src0'").count() / n - 0.5) < 0.05 and abs(kept.filter("lang = 'en'").count() / n - 0.5) < 0.05


def test_exact_top_k(spark):
    draw = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in draw.normal(size=8)]) for i in range(0, 900)]
    vectors += [(900 + i, vectors[7][1]) for i in range(30)]        # ties
    bad = [(2000, None), (2001, [1.0, None]), (2002, [float("nan")]), (2003, [float("inf")]), (None, [1.0])]
    table = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 as v", "2 as shard")
    ints = impacts.integer_vectors(table)
    found = {}
    for r in impacts.top_k(ints, ints.filter("vec_id % 100 = 0"), 10).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    numbers = {i: np.floor(np.array(v) * 1024).astype(int) for i, v in vectors}
    for q in range(0, 1000, 100):
        if q in numbers:
            best = sorted(((-int(numbers[q] @ v), i) for i, v in numbers.items() if i != q))[:10]
            assert sorted(found[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    few = ints.filter("vec_id < 3")
    assert impacts.top_k(few, few, 10).count() == 6 and impacts.top_k(ints.limit(0), ints.limit(0)).count() == 0


def test_url_lists(spark):
    day = dt.date
    entries = [("example.com", day(2024, 1, 10), True), ("example.com", day(2024, 3, 1), False), ("a.example.com", day(2024, 2, 1), True),
               ("a.example.com", day(2024, 2, 1), True), ("b.net", day(2024, 1, 1), True), ("b.net", day(2024, 1, 1), False), (None, day(2024, 1, 1), True)]
    table = spark.createDataFrame(entries, "key string, day date, added boolean")
    captures = [(1, "https://A.Example.com:80/x", day(2024, 1, 20)), (2, "http://a.example.com/", day(2024, 2, 5)),
                (3, "http://u@example.com./", day(2024, 3, 1)), (4, "http://a.example.com/", day(2024, 12, 1)), (5, "http://b.net", day(2024, 5, 1)),
                (6, None, day(2024, 5, 1)), (7, "no url", day(2024, 5, 1)), (8, "http://example.com/", None), (1, "https://A.Example.com:80/x", day(2024, 1, 20))]
    df = spark.createDataFrame(captures, "page_id long, url string, day date").selectExpr("*", "1 as host", "2 as key", "3 as month")
    found = sorted((r.row.page_id, r.listed, r.matched) for r in url_lists.listed_at_fetch(df, table, "url", "day").collect())
    assert found == [(1, True, "example.com"), (1, True, "example.com"), (2, True, "a.example.com"), (3, False, None), (4, True, "a.example.com"),
                     (5, False, None), (6, False, None), (7, False, None), (8, False, None)]
    assert url_lists.listed_at_fetch(df.limit(0), table, "url", "day").count() == 0
    assert not any(r.listed for r in url_lists.listed_at_fetch(df, table.limit(0), "url", "day").collect())


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 140)} == {100} and found[201] == 200


def test_top_k_meets_few_postings(monkeypatch):
    """Most vectors are ruled out by three in five segments; those left are cheaper to score than to meet."""
    rng = np.random.default_rng(6)
    vectors, met = np.floor(1024 * rng.normal(0, 0.125, (3000, 64))).astype(np.int64), []
    index, whole = impacts.ImpactIndex(np.arange(3000), vectors), impacts.ImpactIndex._accumulated
    monkeypatch.setattr(impacts.ImpactIndex, "_accumulated", lambda self, segments, *rest: (
        met.append((self.end[segments] - self.begin[segments]).sum()), whole(self, segments, *rest))[1])
    for own in range(0, 3000, 300):
        score = vectors @ vectors[own]
        want = [i for i in np.lexsort((np.arange(3000), -score)) if i != own][:10]
        rows, scores = index.top(vectors[own], own, 10)
        assert rows.tolist() == want and scores.tolist() == score[want].tolist()
    assert sum(met) < vectors.size * 10
