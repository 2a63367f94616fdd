import hashlib
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablespan import scratch
from tablespan.llm import common, jaccard, langid, packing, repeats, rules, shingles, suffixes, weak_labels, words
from tablespan.scratch import shared_folder
from tests.llm.fixtures import SCHEMA, documents, lowered, rows, words_of

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def stats_of(text):
    w = words_of(text)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def test_statistics_and_base_rules(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for clashing in (False, True):
        found = rules.judged(documents(spark, clashing), labels).select(
            "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
        want = []
        for doc, text, *_ in rows():
            s = stats_of(text)
            failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
            want.append((doc, *s, failed, not failed))
        assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_rules_are_learned(spark):
    good = " ".join(f"word{i}" for i in range(80))
    bad = " ".join(f"word{i}$$" for i in range(80))
    docs = spark.createDataFrame([(i, bad if i % 3 == 0 else good) for i in range(150)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(150)] + [(None, 1), (3, None)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in rules.judged(docs, labels).select("row.doc_id", "kept").collect()}
    assert all(kept[i] == (i % 3 != 0) for i in kept)


def shouting_documents(spark, n, every):
    """Texts with some capitals, and one in `every` in capitals only."""
    docs = []
    for i in range(n):
        words = [f"Word{k}" if k < i % 23 else f"word{k}" for k in range(60 + i % 41)]
        docs.append((i, " ".join(words).upper() if i % every == 0 else " ".join(words)))
    labels = spark.createDataFrame([(i, int(i % every != 0)) for i in range(n)], "doc_id long, quality int")
    return spark.createDataFrame(docs, "doc_id long, text string"), labels


def test_rare_kinds_are_learned(spark):
    docs, labels = shouting_documents(spark, 4000, 160)
    rejected = [r.doc_id for r in rules.judged(docs, labels).filter("not kept").select("row.doc_id").collect()]
    assert sorted(rejected) == list(range(0, 4000, 160))


def test_a_refused_rule_does_not_end_the_list(spark, monkeypatch):
    docs, labels = shouting_documents(spark, 300, 5)
    prune, calls = rules._prune, []

    def once_refused(*args):
        calls.append(args)
        return prune(*args) if len(calls) > 1 else []

    monkeypatch.setattr(rules, "_prune", once_refused)
    docs = docs.withColumn("text", F.expr("if(doc_id % 5 = 0, replace(text, ' ', '! '), text)"))
    assert rules.learn_rules(docs, labels) and len(calls) > 1


def test_rows_that_a_moved_limit_leaves_out_are_learned_again(spark, monkeypatch):
    centred, calls = rules._centred, []

    def moved_far(*args):
        calls.append(args)
        return centred(*args) if len(calls) > 1 else (rules.Term("symbols_per_word", 3.0, True),)

    monkeypatch.setattr(rules, "_centred", moved_far)
    kinds = [" ".join(f"word{i}{end}" for i in range(80)) for end in ("$$", "$$$$", "", "", "")]
    docs = spark.createDataFrame([(i, kinds[i % 5]) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 > 1)) for i in range(200)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in rules.judged(docs, labels).select("row.doc_id", "kept").collect()}
    assert all(kept[i] == (i % 5 > 1) for i in kept)


def components_of(width, percent):
    sets = []
    for _, text, *_ in rows():
        w = words_of(lowered(text))
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    ids = [jaccard.LAST if r[0] is None else r[0] for r in rows()]
    root = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= percent * len(a | b) and root[i] != root[j]:
                    root = [min(root[i], root[j]) if x in (root[i], root[j]) else x for x in root]
                    changed = True
    first = {r: min(ids[i] for i in range(len(ids)) if root[i] == r) for r in root}
    real = [None if x == jaccard.LAST else x for x in (first[r] for r in root)]
    return sorted(repr((r[0], len(s), c)) for r, s, c in zip(rows(), sets, real))


@pytest.mark.parametrize("width, percent, clashing", [(4, 85, False), (5, 80, True)])
def test_components(spark, width, percent, clashing):
    found = jaccard.linked_components(documents(spark, clashing), width, percent).drop("hash", "root")
    assert sorted(repr(tuple(r)) for r in found.collect()) == components_of(width, percent)


def test_large_group_and_common_passage(spark):
    """Many near copies of one text, in pairs that differ by two words, and a passage that all share."""
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(200):
        own = list(base)
        own[i] = f"own{i}"
        texts.append(" ".join(own))
    texts += [" ".join(base[:60] + [f"u{i}-{k}" for k in range(140)]) for i in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.linked_components(docs).collect()}
    assert {got[i] for i in range(200)} == {0} and all(got[i] == i for i in range(200, 300))


def test_one_of_each(spark):
    kept = jaccard.one_of_each(documents(spark, True))
    assert kept.columns == documents(spark, True).columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.select("doc_id").collect()) == [
        -1, 0, 3, 4, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15, 16]


def test_shingle_hashes_follow_words():
    import pyarrow as pa

    texts = pa.array(["A b  c\td", "a B c d", "a b c", None, "", "a bc d e"])
    one, two, three, four, five, six = shingles.shingle_sets(texts, 4)
    assert (one == two).all() and len(one) == len(three) == 1 and one[0] != three[0]
    assert len(four) == len(five) == 0 and six[0] != one[0]


@pytest.mark.parametrize("text", [b"", b"a", b"banana", b"mississippi" * 7, bytes(range(256)), b"abaababaabaab" * 9, b"\0\0a\0"])
def test_suffix_array(text):
    assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def removed(data):
    first, out = {}, []
    ordered = sorted(data, key=lambda r: repeats.LAST if r[0] is None else r[0])
    for doc, text, *_ in ordered:
        raw = (text or "").encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i:i + 50], repeats.LAST if doc is None else doc)
    for doc, text, *_ in ordered:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - 49):
            if first[raw[i:i + 50]] < (repeats.LAST if doc is None else doc):
                gone[i:i + 50] = [True] * 50
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("clashing", [False, True])
def test_repeats(spark, clashing):
    docs = documents(spark, clashing)
    found = repeats.without_repeats(docs, docs.columns).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(repr(tuple(r)) for r in found.collect()) == removed(rows())


def test_common_anchor_is_dealt_out(spark, monkeypatch):
    """A phrase of all documents between different neighbours: its regions must not meet in one block."""
    whole = repeats.shared_spans

    def bounded(block):
        assert block.groupby("anchor")["region"].nunique().max() <= 20
        return whole(block)

    monkeypatch.setattr(repeats, "BLOCK", 20)
    monkeypatch.setattr(repeats, "shared_spans", bounded)
    phrase = "the phrase that all of them hold"
    data = [(i, f"{i * 7919:040d}" + "left neighbour " * (i % 5) + phrase + f" right {i % 3} " * (i % 4) + f"{i * 104729:040d}") for i in range(120)]
    data += [(i, phrase * 3) for i in (200, 201)] + [(7, data[9][1]), (None, "x" * 30 + phrase + "y" * 30), (202, "x" * 30 + phrase + "y" * 30)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = repeats.without_repeats(docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(repr(tuple(r)) for r in found.collect()) == removed(data)


def test_word_ids_equal_the_tokenizer():
    texts = [t or "" for _, t, *_ in rows()] + ["don't WE'LL it's 3x½²", "naïve <|endoftext|> x", "Ǆ ﬁ 中文 \x1c a", "İstanbul ſ"]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert words.WordTokenizer(VOCABULARY).encoded(texts) == want


def test_packing_round_trip(spark):
    docs = documents(spark, True)
    pieces = packing.packed(packing.tokenised_pieces(docs, VOCABULARY, 64, keep_ids=True), 64, block=8)
    found = pieces.collect()
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length for r in found)
    tokenizer, whole = Tokenizer.from_file(VOCABULARY), Counter()
    for _, text, *_ in rows():
        whole[tuple(tokenizer.encode(text or "", add_special_tokens=False).ids + [0])] += 1
    parts = Counter(tuple(r.ids) for r in found)
    assert parts == Counter(ids[k:k + 64] for ids, n in whole.items() for _ in range(n) for k in range(0, len(ids), 64))
    by_sequence = {}
    for r in sorted(found, key=lambda r: r.offset):
        assert by_sequence.setdefault(r.sequence_id, 0) == r.offset
        by_sequence[r.sequence_id] += r.length
    assert max(by_sequence.values()) <= 64
    built = {r.sequence_id: len(r.ids) for r in packing.sequences(pieces).collect()}
    assert built == by_sequence
    assert len(by_sequence) <= 1.15 * sum(by_sequence.values()) / 64 + 1


def test_crossover_keeps_every_piece():
    sizes = [int(x) for x in np.random.default_rng(1).integers(1, 100, 300)]
    best = packing.evolve(sizes, 100, 7, [])[0]
    assert sorted(i for b in best for i in b) == list(range(300)) and all(sum(sizes[i] for i in b) <= 100 for b in best)
    first = packing.best_fit(sorted(range(300), key=lambda i: -sizes[i]), sizes, 100)
    assert len(best) <= len(first)


def test_language(spark):
    docs = spark.createDataFrame([(i, ["the house and the tree ", "das haus und der baum "][i % 2] * 5, ["en", "de"][i % 2]) for i in range(40)]
                                 + [(100, None, "en"), (101, "123 !!", "en"), (102, "the the", None), (103, "ЖЖЖ", None)],
                                 "doc_id long, text string, lang string")
    model = langid.fit(docs.filter("doc_id % 4 < 2"))
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model, ["doc_id"]).collect()}
    assert all(found[i][0] == ["en", "de"][i % 2] for i in range(40)) and found[102][0] == "en"
    assert found[100] == found[101] == ("und", 0.0) and found[103][0] in ("de", "en") and found[103][1] < 0.1
    nothing = langid.fit(docs.filter("false"))
    assert {r.lang_pred for r in langid.predict(docs, nothing, ["doc_id"]).collect()} == {"und"}


def test_weak_labels(spark):
    good = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(i, "#$%! " * 60 if i % 4 == 0 else good + f" {i}") for i in range(80)] + [(None, None), (3, "")],
                                 "doc_id long, text string")
    found = {r.doc_id: r.kept for r in weak_labels.classified(docs).collect() if r.doc_id is not None and r.doc_id != 3}
    assert all(found[i] == (i % 4 != 0) for i in found)


def test_posteriors_find_accurate_labellers():
    draw, counts = np.random.default_rng(3), Counter()
    for _ in range(4000):
        bad = draw.random() < 0.2
        code = 0
        for right in (0.9, 0.8, 0.7):
            code = code * 3 + ((0 if draw.random() < right else 2) if bad else (1 if draw.random() < 0.9 else 2))
        counts[code] += 1
    good, chance = weak_labels.posteriors(counts, 3)
    assert good[0] < 0.01 and good[13] > 0.9 and chance[0, 0, 0] > chance[2, 0, 0]


@pytest.mark.parametrize("operator", [
    lambda d: rules.judged(d, d.sparkSession.createDataFrame([], "doc_id long, quality int")), jaccard.linked_components,
    jaccard.one_of_each, repeats.without_repeats, lambda d: packing.packed(packing.tokenised_pieces(d, VOCABULARY)),
    weak_labels.classified, lambda d: langid.predict(d, langid.fit(d), ["doc_id"])])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0


def test_known_words_are_not_gathered_again(monkeypatch):
    tokenizer, met = words.WordTokenizer(VOCABULARY), []
    learn = tokenizer._learn
    monkeypatch.setattr(tokenizer, "_learn", lambda new: (met.append(set(new)), learn(new)))
    first = tokenizer.encoded(["one two", "two don't"])
    assert tokenizer.encoded(["two don't three", "one two"])[1] == first[0]
    assert met == [{"one", "two", "don", "'t"}, {"three"}]


def test_words_are_learned_by_the_model_alone():
    every = [chr(c) for c in range(0x100, 0x17F) if words._PLAIN.fullmatch(chr(c))] + [chr(c) for c in range(0x20, 0x100)]
    texts = [" ".join(f"a{c}b {c}{c} {c}" for c in every if words._PLAIN.fullmatch(c)), "naïve déjà-vu ÀÉÎ½x²", "the theses' 's", "l" * 3000]
    tokenizer = words.WordTokenizer(VOCABULARY)
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.tokenizer.encode_batch(texts, add_special_tokens=False)]
    tokenizer.tokenizer = None                      # with its normaliser and its splitting
    assert tokenizer.encoded(texts) == want


def test_copies_with_changes_of_their_own_do_not_meet(spark, monkeypatch):
    """Copies too far from each other for a link share most of what stands after their own changes."""
    base, found, whole = [f"w{i}" for i in range(300)], [], jaccard._candidate_groups
    texts = []
    for i in range(30):
        copy = list(base)
        for k in range(i % 11, 300, 30 if i % 10 else 100):  # an eighth of the shingles is changed, in a tenth of the copies less
            copy[k] = f"own{i}x{k}"
        texts.append((i, " ".join(copy), None, None, 0))

    def counted(*args):
        found.append(whole(*args))
        return found[0]

    monkeypatch.setattr(jaccard, "_candidate_groups", counted)
    docs = spark.createDataFrame(texts, SCHEMA)
    got = {r.doc_id: r.component_id for r in jaccard.linked_components(docs).collect()}
    sets = {i: {tuple(t.split()[k:k + 4]) for k in range(297)} for i, t, *_ in texts}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    least = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == least and 0 < len(links) < 30
    assert found[0].count() < 60


def test_a_document_with_nothing_to_lose_is_not_cut(spark, monkeypatch):
    """Most documents share no bytes; they stay as they are without a trip through Python."""
    cut, batches = repeats._cut, spark.sparkContext.accumulator(0)

    def counted(rows):
        for batch in rows:
            batches.add(batch.num_rows)
            yield from cut(iter([batch]))

    monkeypatch.setattr(repeats, "_cut", counted)
    passage = "a passage that two documents have, longer than the window of fifty bytes"
    data = [(i, None if i == 5 else f"{i * 7919:07d}é " * (i % 9)) for i in range(40)] + [(50, "x" + passage), (51, "y" + passage)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = repeats.without_repeats(docs, ["doc_id", "text"])
    rows = {r.row.doc_id: r for r in found.collect()}
    assert rows[51].text == "y" and rows[51].row.text == "y" + passage and rows[5].text == "" and rows[5].n_bytes == 0
    for i, t in data[:-1]:
        raw = (t or "").encode()
        assert (rows[i].n_bytes, rows[i].n_removed, rows[i].n_spans, rows[i].text) == (len(raw), 0, 0, t or "")
        assert rows[i].kept_sha256 == hashlib.sha256(raw).hexdigest()
    assert batches.value < 10


def test_copies_meet_through_their_differences_from_the_head(spark, monkeypatch):
    """Changes that several copies have are no copy's own; most of the copies still are too far from each other and from
    the base for a link, some are linked with each other only."""
    draw, base, rows, whole = random.Random(9), [f"w{i}" for i in range(300)], [], jaccard._meeting
    changed = [draw.sample(range(2, 298, 4), 9) for _ in range(40)]
    changed += [[], *(c[1:] for c in changed[:3]), *(c[2:] + [299] for c in changed[:2])]
    texts = []
    for i, places in enumerate(changed):
        copy = list(base)
        for k in places:
            copy[k] = f"other{k}"
        texts.append((i, " ".join(copy), None, None, 0))

    def counted(*args):
        rows.append(whole(*args).count())
        return whole(*args)

    monkeypatch.setattr(jaccard, "_meeting", counted)
    docs = spark.createDataFrame(texts, SCHEMA)
    got = {r.doc_id: r.component_id for r in jaccard.linked_components(docs).collect()}
    sets = {i: {tuple(t.split()[k:k + 4]) for k in range(297)} for i, t, *_ in texts}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    least = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == least and len({*least.values()}) > 30 and sum(least[i] < i for i in least) >= 3
    assert sum(rows) < 1500, rows    # the base meets each copy; the copies hardly meet


def test_anchors_are_shuffled_packed(monkeypatch):
    """Many anchors travel in a few rows; those of two documents are found, also where they were packed apart."""
    monkeypatch.setattr(repeats, "PACKED", 500)
    draw = random.Random(4)
    texts = ["".join(draw.choice("abcdefgh ") for _ in range(900)) for _ in range(40)]
    texts += [texts[3][100:400] + texts[5], "short", None, texts[7][:60] * 3]
    count = Counter(a for t in texts for a in set(repeats.anchors(pa.array([t], pa.string()))[2].view(np.int64).tolist()))
    batches = [pa.record_batch([pa.array([i]), pa.array([t], pa.string())], names=["doc", "text"]) for i, t in enumerate(texts)]
    packed = list(repeats._documents_of_anchors(4)(iter(batches)))
    rows = [r for b in packed for r in b.to_pylist()]
    assert len(packed) > 2 and len(rows) <= 4 * len(packed) < sum(count.values()) / 20
    found = []
    for part in range(4):
        own = [b.filter(pc.equal(b.column(0), part)) for b in packed]
        found += [a for b in repeats._repeated(iter(own)) for a in b.column(0).to_pylist()]
    assert sorted(found) == sorted(a for a, n in count.items() if n > 1) and found
    assert [b.num_rows for b in repeats._repeated(iter([]))] == [0]


def test_far_copies_meet_the_members_of_their_heads_group(spark, monkeypatch):
    """Copies too far from the head are linked with it through members of its group only, and meet no whole group."""
    draw, base, found, whole = random.Random(3), [f"w{i}" for i in range(300)], [], jaccard._candidate_groups
    members = [draw.sample(range(2, 298, 4), i % 7) for i in range(60)]
    far = [draw.sample(range(2, 298, 4), 9) for _ in range(25)]
    far += [c + draw.sample([k for k in range(2, 298, 4) if k not in c], 4) for c in members if len(c) == 5][:4]
    texts = []
    for i, places in enumerate(far + members):
        copy = list(base)
        for k in places:
            copy[k] = f"other{k}" if k % 8 else f"own{i}x{k}"
        texts.append((i, " ".join(copy), None, None, 0))

    def counted(*args):
        found.append(whole(*args))
        return found[0]

    monkeypatch.setattr(jaccard, "_candidate_groups", counted)
    docs = spark.createDataFrame(texts, SCHEMA)
    got = {r.doc_id: r.component_id for r in jaccard.linked_components(docs).collect()}
    sets = {i: {tuple(t.split()[k:k + 4]) for k in range(297)} for i, t, *_ in texts}
    least = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    group = [least[i] for i in sets if i >= len(far)]
    assert got == least and max(group.count(x) for x in group) > 50 and 4 <= sum(least[i] in group for i in range(len(far))) < 29
    assert found[0].count() < 10    # no far copy meets the group


@pytest.mark.parametrize("operator", ["written_components", "one_of_each", "without_repeats"])
def test_tables_on_the_way_are_removed(spark, operator):
    """What an operator wrote on its way to its result goes with the step, not with the job."""
    passage = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(i, f"{passage} {'x' * (i % 3)} {passage}{i}") for i in range(12)], "doc_id long, text string")
    folder = Path(shared_folder(spark).removeprefix("file:")) / "tablespan"
    before, names = set(folder.glob("*")), {t.name for t in spark.catalog.listTables()}
    rows = getattr(repeats if operator == "without_repeats" else jaccard, operator)(docs).count()
    assert rows and len(set(folder.glob("*")) - before) == 1
    assert {t.name for t in spark.catalog.listTables()} == names


def test_filter_of_anchors_grows_with_them(spark, monkeypatch):
    """More anchors are shared than the least table has bits; those of one document only still do not travel."""
    draw, written, whole = random.Random(8), [], repeats.bucketed_table
    texts = ["".join(draw.choice("abcdefgh ") for _ in range(800)) for _ in range(300)]
    data = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t[:200] + "#" + t[500:550][::-1]) for i, t in enumerate(texts)]
    count = Counter(a for _, t in data for a in set(repeats.anchors(pa.array([t]))[2].tolist()))
    wanted = sum(count[a] > 1 for _, t in data for a in repeats.anchors(pa.array([t]))[2].tolist())

    def counted(*args):
        table = whole(*args)
        written.append(table.count())
        return table

    monkeypatch.setattr(common, "BITS", 1 << 10)
    monkeypatch.setattr(repeats, "bucketed_table", counted)
    found = repeats.without_repeats(spark.createDataFrame(data, "doc_id long, text string"))
    rows = sorted(repr(tuple(r)) for r in found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert rows == removed(data)
    assert sum(c > 1 for c in count.values()) > 1 << 10 and wanted <= written[0] < 1.2 * wanted < 0.5 * sum(count.values())


@pytest.mark.parametrize("slice_", [common.SLICE, 16])
def test_bit_table(spark, monkeypatch, slice_):
    monkeypatch.setattr(common, "SLICE", slice_)
    values = [-(1 << 63), -5, 0, 1, 77, 4095, 4096, (1 << 63) - 1]
    table = common.bit_table(spark.createDataFrame([(v,) for v in values], "v long"), 1 << 12)
    asked = np.array([*values, 2, 78, 4094, -6], np.int64)
    assert common.has_bit(table, asked).tolist() == [True] * 8 + [False, False, False, False]
    assert [common.bits_for(n) for n in (0, 1 << 23, (1 << 23) + 1, 1 << 40)] == [1 << 26, 1 << 26, 1 << 27, 1 << 30]


def test_tables_of_finished_steps_are_removed(spark, monkeypatch):
    """What op10 wrote for one step does not lie on disk during the next."""
    folder, there, made = Path(shared_folder(spark).removeprefix("file:")) / "tablespan", {}, scratch.new_path
    before = set(folder.glob("*"))

    def noted(session, label):
        there[label] = {p.name.rpartition("-")[0] for p in set(folder.glob("*")) - before}
        return made(session, label)

    monkeypatch.setattr(scratch, "new_path", noted)
    monkeypatch.setattr(repeats, "BLOCK", 20)
    phrase, other = "the phrase that all of them hold", "a passage of some more than fifty bytes that a few have"
    data = [(i, f"{i * 7919:040d} {phrase} {i * 104729:040d}" + (other + f"{i % 3}") * (i % 9 == 0)) for i in range(90)]
    found = repeats.without_repeats(spark.createDataFrame(data, "doc_id long, text string"))
    rows = sorted(repr(tuple(r)) for r in found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert rows == removed(data)
    assert there["spans-by-window"] <= {"copies", "occurrences", "shared-regions", "windows", "window-classes"}
    assert there["spans"] == {"copies", "occurrences", "shared-regions", "spans-by-window", "pieces"}
    assert there["covered"] == {"copies", "occurrences", "spans"}
