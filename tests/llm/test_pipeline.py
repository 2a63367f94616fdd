"""The pipeline's stages one by one against plain Python, each on what the stage before it kept."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.fixtures import SCHEMA, lowered, sentences, words_of


def documents():
    base, other, passage = sentences(1, 150), sentences(2, 120), sentences(3, 30)
    texts = [base, base, base.replace(base.split()[70], "changed", 1), other + " " + passage, passage + "\n" + sentences(4, 90), None, "", "short",
             sentences(6, 80) + " $$$" * 30, "spam ham " * 60]
    texts += [sentences(20 + i, 70 + i) for i in range(30)]
    return [(i, t, "en", "src1", len(t or "")) for i, t in enumerate(texts)]


def similar(a, b):
    return a and b and 100 * len(a & b) >= 80 * len(a | b)


def without_earlier_strings(kept):
    first, out = {}, {}
    for doc, text in sorted(kept.items()):
        raw = text.encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - 49):
            if first.setdefault(raw[i:i + 50], doc) < doc:
                gone[i:i + 50] = [True] * 50
        out[doc] = bytes(b for b, g in zip(raw, gone) if not g).decode(errors="ignore")
    return {d: t for d, t in out.items() if t or not kept[d]}


def test_stages(spark, tmp_path):
    docs = spark.createDataFrame(documents(), SCHEMA)
    labels = spark.createDataFrame([(i, 1) for i in range(10, 30)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    results = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        results.append(docs.collect())
        assert k == 4 or docs.columns == SCHEMA.names
    rules, near, cut, mixed, packed = results

    texts = {doc: text for doc, text, *_ in documents()}
    passed = {d: t for d, t in texts.items() if len(words_of(t)) >= 50 and d != 9}
    assert {r.doc_id: r.text for r in rules} == passed

    shingles = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for d, w in ((d, words_of(lowered(t))) for d, t in passed.items())}
    first = {d: t for d, t in passed.items() if not any(e < d and similar(shingles[d], shingles[e]) for e in passed)}
    assert {r.doc_id: r.text for r in near} == first and len(first) < len(passed)

    shorter = without_earlier_strings(first)
    assert {r.doc_id: r.text for r in cut} == shorter and shorter != first
    assert all(r.n_chars == len(r.text) for r in cut)

    assert {r.doc_id for r in mixed} <= set(shorter) and all(r.text == shorter[r.doc_id] for r in mixed) and mixed

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for r in mixed:
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [0]
        want[r.doc_id] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert {r.doc_id: (r.length, r.ids_crc32) for r in packed} == want
    room = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert room.setdefault(r.sequence_id, 0) == r.offset
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 2048


def test_no_documents(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
