"""Language identification by n-gram filters that answer for all languages at once.

Fitting counts, for each letter n-gram and language, the documents that hold it. A language keeps the n-grams that at
least MIN_SHARE of its documents hold, and puts them into one bit-sliced Bloom filter: SLOTS slots of one bit per
language; an n-gram sets its language's bit in HASHES slots. A look-up reads those slots, and the bitwise "and" of
their masks names all languages that hold the n-gram. A document's hits are counted per language, corrected for the
share of n-grams that a language's bits accept by chance, and weighed by nothing else; the language with the most wins.

The filter has a fixed size (SLOTS x 8 bytes, for up to 64 languages), built from at most SLOTS rows. Counts cover all
labelled documents given. Texts are worked on whole, many at a time.

N-grams are the runs of 2, 3 and 4 lower-cased letters of words with a mark at either end of a word.

Defined results: a text that is null or has no letter is "und" with score 0; a text none of whose n-grams is known, or
any text when nothing could be learned, gets the language with most documents ("und" if there is none), score 0; ties
go to the language that comes first in the alphabet; rows with null text or null language teach nothing; repeated rows
count each time; columns besides text and the language are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablespan.llm.common import text_blocks
from tablespan.llm.shingles import mix

GRAMS = (2, 3, 4)
SLOTS, HASHES = 1 << 19, 3
MIN_SHARE = 0.02           # of a language's documents
MAX_LANGUAGES = 64
UNKNOWN = "und"
_SPACE = 32


@cache
def _letters() -> np.ndarray:
    """For every code point: itself if a letter, else a space."""
    return np.array([c if chr(c).isalpha() else _SPACE for c in range(0x110000)], np.uint32)


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of all texts, and the text number of each."""
    joined = " " + "  ".join(texts).lower() + " "
    lengths = np.array([len(t.lower()) for t in texts], np.int64) + 2
    code = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    keep = np.ones(len(code), bool)         # of several spaces in a row one stays
    keep[1:] = (code[1:] != _SPACE) | (code[:-1] != _SPACE)
    keep[1:] |= owner[1:len(code)] != owner[:len(code) - 1]
    code, owner = code[keep].astype(np.uint64), owner[:len(keep)][keep]
    hashes, owners = [], []
    for n in GRAMS:
        if len(code) < n:
            continue
        gram = np.full(len(code) - n + 1, n, np.uint64)
        inner = np.zeros(len(gram), bool)
        for k in range(n):
            part = code[k:len(code) - n + 1 + k]
            gram = (gram << np.uint64(21)) ^ part ^ (gram >> np.uint64(43))
            if 0 < k < n - 1:
                inner |= part == _SPACE
        whole = ~inner & (owner[:len(gram)] == owner[n - 1:]) & ((code[:len(gram)] != _SPACE) | (code[n - 1:] != _SPACE))
        hashes.append(mix(gram[whole]))
        owners.append(owner[:len(gram)][whole])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    return np.concatenate(hashes), np.concatenate(owners)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """gram, lang, n: documents of a slice of rows that hold the n-gram."""
    for batch in text_blocks(batches):
        langs = batch.column(1).to_pylist()
        hashes, owner = gram_hashes(batch.column(0).to_pylist())
        number = {lang: k for k, lang in enumerate(dict.fromkeys(langs))}
        order = np.lexsort((owner, hashes))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        of = np.array([number[x] for x in langs], np.int64)[owner[new]]
        hashes = hashes[new]
        for lang, k in number.items():
            grams, n = np.unique(hashes[of == k], return_counts=True)
            yield pa.record_batch([pa.array(grams.view(np.int64)), pa.array([lang] * len(grams), pa.string()), pa.array(n.astype(np.int64))],
                                  names=["gram", "lang", "n"])


class Filter:
    """The bit-sliced filter: a mask of languages per slot."""

    def __init__(self, languages: list[str], usual: str, masks: np.ndarray):
        self.languages, self.usual, self.masks = languages, usual, masks
        bits = (masks[:, None] >> np.arange(len(languages), dtype=np.uint64)) & np.uint64(1) if languages else np.zeros((1, 0))
        self.chance = bits.mean(axis=0) ** HASHES    # share of unknown n-grams accepted, per language

    def masks_of(self, hashes: np.ndarray) -> np.ndarray:
        out = None
        for slot in slots_of(hashes):
            out = self.masks[slot] if out is None else out & self.masks[slot]
        return out


def slots_of(hashes: np.ndarray) -> list[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return [((hashes + np.uint64(k) * step) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(HASHES)]


def fit(documents: DataFrame, lang: str = "lang") -> Filter:
    known = documents.select("text", F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    if (found := sizes.count()) > MAX_LANGUAGES:
        raise ValueError(f"{found} languages; a slot has {MAX_LANGUAGES} bits")
    docs = {r.lang: r.docs for r in sizes.collect()}
    languages = sorted(docs)
    usual = max(languages, key=lambda x: docs[x], default=UNKNOWN)
    masks = np.zeros(SLOTS, np.uint64)
    if languages:
        counts = known.mapInArrow(_counted, "gram long, lang string, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
        bit, least = F.lit(0).cast("long"), F.lit(0.0)
        for k, x in enumerate(languages):
            bit = F.when(F.col("lang") == x, F.lit(1 << k if k < 63 else -1 << 63)).otherwise(bit)
            least = F.when(F.col("lang") == x, F.lit(MIN_SHARE * docs[x])).otherwise(least)
        common = counts.filter(F.col("n") >= least).select("gram", bit.alias("bit"))
        slots = common.mapInArrow(_placed, "slot int, bit long").groupBy("slot").agg(F.bit_or("bit").alias("mask")).toPandas()
        masks[slots["slot"].to_numpy(np.int64)] = slots["mask"].to_numpy(np.int64).view(np.uint64)
    return Filter(languages, usual, masks)


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for slot in slots_of(batch.column(0).to_numpy().view(np.uint64)):
            yield pa.record_batch([pa.array(slot.astype(np.int32)), batch.column(1)], names=["slot", "bit"])


def predict(documents: DataFrame, model: Filter, carried: list[str]) -> DataFrame:
    """The carried columns with lang_pred and score: the winner's share, of the text's n-grams, less chance."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, model.usual, UNKNOWN], object)
        for batch in text_blocks(batches):
            texts = batch.column(0).fill_null("").to_pylist()
            hashes, owner = gram_hashes(texts)
            masks = model.masks_of(hashes)
            total = np.bincount(owner, minlength=len(texts)).astype(float)
            share = np.zeros((len(texts), len(model.languages)))
            for k, chance in enumerate(model.chance):
                hits = np.bincount(owner, ((masks >> np.uint64(k)) & np.uint64(1)).astype(float), len(texts))
                share[:, k] = np.clip((hits / np.maximum(total, 1) - chance) / max(1e-9, 1 - chance), 0, 1)
            best = share.argmax(axis=1) if model.languages else np.zeros(len(texts), np.int64)
            score = share.max(axis=1) if model.languages else np.zeros(len(texts))
            best = np.where(score > 0, best, len(model.languages))
            best = np.where(total > 0, best, len(model.languages) + 1)
            yield pa.record_batch([batch.column(1), pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64())],
                                  names=["row", "lang_pred", "score"])

    rows = documents.select("text", F.struct(*carried).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, lang_pred string, score double").select("row.*", "lang_pred", "score")
