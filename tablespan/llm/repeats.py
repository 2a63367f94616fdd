"""Suffix-array removal of byte strings that an earlier document already has.

A byte goes if it lies in a string of WINDOW bytes that also starts in a document with a smaller doc_id. No suffix
array of a whole corpus fits one machine, so suffixes are first dealt into blocks that cannot miss a match:

0. Copies. Of documents with the same text only the one with the smallest doc_id goes on; the others lose everything.
1. Anchors. Of the KEY-byte substrings of a window the one with the smallest hash is its anchor, so equal windows have
   equal anchors at equal places. Only anchors of more than one document matter.
2. Regions. An occurrence of an anchor has around it all windows it may serve, at most WINDOW - KEY bytes either way.
   Occurrences with the same region are one, whatever their number; an anchor whose occurrences all have the same
   region is settled: its windows are in all those documents. The other regions go to blocks, all of one anchor to the
   same block, and anchors of the same earliest document together, so that overlapping regions join up to stretches.
3. In a block regions are trimmed to what a sibling may share, and the suffix array of the distinct stretches is built
   by linear grouping construction (`suffixes`). Neighbours in the array with equal windows form a class, and the
   smallest document of a class decides.
4. Occurrences take the spans of their regions; each document's spans are united and cut.

A bit table tells, before the second shuffle, which anchors can be shared. It has two bits for an anchor and grows with
their number up to `common.MOST_BITS`; beyond that it spares less but changes no result. Tables staged on the way to a
step's result go when that is written, so disk holds the occurrences and the tables of one step at a time. A block holds
about BLOCK regions, beyond that anchors of one document are dealt over several. An anchor with more than BLOCK regions
of its own (a phrase of many documents between different neighbours) goes to no block: equal windows have it at the same
place, so its windows are dealt by their hashes, the smallest document of each distinct window is reduced task by task,
and no task gathers the anchor's regions.

Defined results: a null text is empty and stays as it is; texts shorter than WINDOW bytes lose nothing; rows of the same
doc_id never remove from each other; a null doc_id counts as larger than any other; columns besides doc_id and text
are ignored; an empty table gives no rows. Texts are bytes
throughout, so a cut may fall inside a character; `text` leaves out the bytes of such a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablespan.llm.common import bit_table, bits_for, bucketed_table, has_bit, may_be_in, stage_alone, stage_table, text_blocks
from tablespan.llm.shingles import mix, text_bytes
from tablespan.llm.suffixes import suffix_array
from tablespan.scratch import removed_after

WINDOW, KEY = 50, 24
AROUND = WINDOW - KEY
BLOCK = 4000
#: Anchors that a task gathers before it packs them.
PACKED = 1 << 20
#: Stands for a null doc_id.
LAST = (1 << 63) - 1

_BYTE = np.random.default_rng(50).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x2545F4914F6CDD1D


def _key_hashes(body: np.ndarray) -> np.ndarray:
    """Hashes of all KEY-byte substrings, put together from those of powers of two."""
    part, width, left, out, have = _BYTE[body], 1, KEY, None, 0
    while left:
        factor = np.uint64(pow(_BASE, width, 1 << 64))
        if left & 1:
            out = part if out is None else out[:len(part) - have] * factor + part[have:]
            have += width
        left >>= 1
        if left:
            part = part[:-width] * factor + part[width:]
            width *= 2
    return mix(out[:len(body) - KEY + 1])


def _sliding(values: np.ndarray, n: int, choose) -> np.ndarray:
    width = 1
    while 2 * width <= n:
        values = choose(values[:-width], values[width:])
        width *= 2
    return choose(values[:len(values) - (n - width)], values[n - width:]) if width < n else values


def anchors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts' bytes and where each begins; then for each anchor its hash, text number and place in the bytes."""
    body, at = text_bytes(texts)
    nothing = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    if len(body) < WINDOW:
        return body, at, *nothing
    span = AROUND + 1
    hashes = _key_hashes(body)
    least = _sliding(hashes, span, np.minimum)
    whole = np.ones(len(least), bool)      # windows inside one text
    for back in range(1, WINDOW):
        inner = at[1:-1] - back
        whole[inner[(inner >= 0) & (inner < len(least))]] = False
    least[~whole] = 0
    edge = np.zeros(AROUND, np.uint64)
    chosen = np.flatnonzero((_sliding(np.concatenate([edge, least, edge]), span, np.maximum) == hashes) & (hashes > 0))
    return body, at, hashes[chosen], np.searchsorted(at, chosen, side="right") - 1, chosen


def _documents_of_anchors(parts: int):
    """The anchors of each document, once, as packed numbers of each of `parts` parts of all hashes."""
    def packed(found: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.concatenate(found)
        part = (hashes >> np.uint64(33)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64)).tolist()
        hashes = hashes[order]
        some = [k for k in range(parts) if ends[k] < ends[k + 1]]
        cells = [hashes[ends[k]:ends[k + 1]].tobytes() for k in some]
        return pa.record_batch([pa.array(some, pa.int32()), pa.array(cells, pa.binary())], names=["part", "anchors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for batch in text_blocks(batches):
            _, _, hashes, owner, _ = anchors(batch.column(1))
            order = np.lexsort((owner, hashes))
            hashes, owner = hashes[order], owner[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            found.append(hashes[new])
            if sum(map(len, found)) >= PACKED:
                yield packed(found)
                found = []
        if found:
            yield packed(found)

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors that come more than once in the parts at hand. A part is whole in one task."""
    found = [np.frombuffer(cell.as_buffer(), np.int64) for batch in batches for cell in batch.column(1)]
    values = np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)
    again = values[1:][values[1:] == values[:-1]]
    first = np.ones(len(again), bool)
    first[1:] = again[1:] != again[:-1]
    yield pa.record_batch([pa.array(again[first])], names=["anchor"])


def _anchor_bits(found: DataFrame, tasks: int) -> np.ndarray:
    """The bit table of the anchors that come more than once: the lower and the upper half of each are two values."""
    with removed_after(found.sparkSession):
        shared = stage_table(found.repartition(tasks, "part").mapInArrow(_repeated, "anchor long"), "shared")
        halves = F.array("anchor", F.shiftrightunsigned("anchor", 32))
        return bit_table(shared.select(F.explode(halves).alias("half")), bits_for(shared.count()))


def _occurrences(bits: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            body, at, hashes, owner, place = anchors(batch.column(1))
            may = np.flatnonzero(has_bit(bits.value, hashes))
            may = may[has_bit(bits.value, hashes[may] >> np.uint64(32))]
            hashes, owner, place = hashes[may], owner[may], place[may]
            left = np.maximum(at[owner], place - AROUND)
            right = np.minimum(at[owner + 1], place + KEY + AROUND)
            raw = body.tobytes()
            regions = [xxhash.xxh3_64_intdigest(raw[a:b], p - a) for a, b, p in zip(left.tolist(), right.tolist(), place.tolist())]
            yield pa.record_batch([
                pa.array(hashes.view(np.int64)), pa.array(np.array(regions, np.uint64).view(np.int64)),
                batch.column(0).take(pa.array(owner)), batch.column(2).take(pa.array(owner)), pa.array(place - at[owner])],
                names=["anchor", "region", "doc", "digest", "pos"])

    return run


def _region_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the regions named by each document's list."""
    for batch in text_blocks(batches):
        listed = batch.column(1)
        fields = dict(zip([f.name for f in listed.type.value_type], listed.flatten().flatten()))
        owner = np.repeat(np.arange(batch.num_rows), listed.value_lengths().to_numpy())
        raw = [t.encode() for t in batch.column(0).fill_null("").to_pylist()]
        left = np.minimum(fields["pos"].to_numpy(), AROUND)
        begin = fields["pos"].to_numpy() - left
        ends = fields["pos"].to_numpy() + KEY + AROUND
        parts = [raw[o][a:b] for o, a, b in zip(owner.tolist(), begin.tolist(), ends.tolist())]
        yield pa.record_batch([*fields.values(), pa.array(left), pa.array(parts, pa.binary())], names=[*fields, "left", "bytes"])


def _region_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of the regions named by each document's list: where each begins, from the anchor, and its hash."""
    for batch in _region_texts(batches):
        begin, hashes, count = [], [], []
        for raw, left in zip(batch.column("bytes").to_pylist(), batch.column("left").to_pylist()):
            n = max(0, len(raw) - WINDOW + 1)
            begin += range(-left, n - left)
            hashes += [xxhash.xxh3_64_intdigest(raw[i:i + WINDOW]) for i in range(n)]
            count.append(n)
        whose = pa.array(np.repeat(np.arange(batch.num_rows), count))
        kept = ["anchor", "region", "lo", "hi"]
        yield pa.record_batch([*(batch.column(c).take(whose) for c in kept), pa.array(begin, pa.int64()),
                               pa.array(np.array(hashes, np.uint64).view(np.int64))], names=[*kept, "begin", "window"])


def _sibling_reach(anchor: np.ndarray, sides: list[bytes]) -> np.ndarray:
    """How far each side agrees, from its start, with that of some other row of the same anchor."""
    n, width = len(sides), -(-AROUND // 8) * 8
    table = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in sides), np.uint8).reshape(n, width)
    words = table.view(">u8")
    order = np.lexsort([*(words[:, k] for k in range(words.shape[1] - 1, -1, -1)), anchor])
    sorted_rows = table[order]
    common = np.cumprod(sorted_rows[1:] == sorted_rows[:-1], axis=1).sum(axis=1)
    common[anchor[order][1:] != anchor[order][:-1]] = 0
    reach = np.zeros(n, np.int64)
    reach[order[1:]] = common
    np.maximum.at(reach, order[:-1], common)
    return np.minimum(reach, [len(s) for s in sides])


def shared_spans(rows: pd.DataFrame) -> pd.DataFrame:
    """For the regions of one block: spans of windows that also start in document `least`, as offsets from the anchor."""
    rows = rows.drop_duplicates(["anchor", "region"]).reset_index(drop=True)
    anchor, raw, left = rows["anchor"].to_numpy(), rows["bytes"].tolist(), rows["left"].tolist()
    lo, hi = rows["lo"].to_numpy(), rows["hi"].to_numpy()
    several = lo < hi
    before = np.where(several, left, _sibling_reach(anchor, [b[:k][::-1] for b, k in zip(raw, left)]))
    after = np.where(several, [len(b) - k - KEY for b, k in zip(raw, left)],
                     _sibling_reach(anchor, [b[k + KEY:] for b, k in zip(raw, left)]))
    keep = np.flatnonzero(before + KEY + after >= WINDOW)
    starts = rows["pos"].to_numpy() - before
    keep = keep[np.lexsort((starts[keep], rows["digest"].to_numpy()[keep], rows["doc"].to_numpy()[keep]))].tolist()
    # distinct trimmed regions, joined up where they overlap in their document
    text, at, known = bytearray(), {}, {}
    owner, upto = None, 0                 # document of the stretch being built, and its end there
    doc, digest, start_of, anchor_of = rows["doc"].tolist(), rows["digest"].tolist(), starts.tolist(), anchor.tolist()
    region, before_of, after_of = rows["region"].tolist(), before.tolist(), after.tolist()
    for i in keep:
        a, b = left[i] - before_of[i], left[i] + KEY + after_of[i]
        piece = raw[i][a:b]
        same = (anchor_of[i], before_of[i], piece)
        if same in known:
            at[i] = known[same]
            continue
        start = start_of[i]
        end = start + len(piece)
        document = (doc[i], digest[i])
        if document != owner or start > upto:
            text += b"\0" if text else b""
            text += piece
            owner, upto = document, end
        elif end > upto:
            text += piece[upto - start:]
            upto = end
        known[same] = at[i] = len(text) - (upto - start)
    text = bytes(text)
    # windows of kept regions, and the class of each by the order of suffixes
    count = {i: before_of[i] + KEY + after_of[i] - WINDOW + 1 for i in at}    # windows of a region
    inside = np.zeros(len(text) + 1, bool)
    for i, p in at.items():
        inside[p:p + count[i]] = True
    kind = np.full(len(text) + 1, -1, np.int64)
    last, number, flags = b"", -1, inside.tobytes()
    for s in suffix_array(text):
        if flags[s]:
            window = text[s:s + WINDOW]
            if window != last:
                last, number = window, number + 1
            kind[s] = number
    # the smallest document of each class, from the windows of all regions end to end
    regions = np.array(list(at), np.int64)
    size = np.array(list(count.values()), np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    offset = np.arange(first[-1]) - np.repeat(first[:-1], size)
    of = kind[np.repeat(np.array(list(at.values()), np.int64), size) + offset]
    least = np.full(number + 2, LAST, np.int64)
    np.minimum.at(least, of, np.repeat(lo[regions], size))
    found = least[of]
    # runs of windows with the same smallest document, within a region
    edge = np.ones(len(found), bool)
    edge[1:] = (found[1:] != found[:-1]) | (offset[1:] == 0)
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(found))[:len(begin)] - 1    # none in a block without a window
    whose = np.repeat(regions, size)[begin]
    out = pd.DataFrame({"anchor": anchor[whose], "region": np.array(region, np.int64)[whose], "begin": offset[begin] - before[whose],
                        "end": offset[end] - before[whose] + WINDOW, "least": found[begin]})
    return out[out["least"].to_numpy() < hi[whose]].astype("int64")


def _united(begin: np.ndarray, end: np.ndarray, n: int) -> tuple[list[int], list[int]]:
    """Maximal runs covered by the spans, within n bytes."""
    order = np.argsort(begin, kind="stable")
    begin, end = np.maximum(begin[order], 0), np.maximum.accumulate(np.minimum(end[order], n))
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    return begin[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, spans, text), cut. The text is in the row if that has one, so that it travels once."""
    for batch in text_blocks(batches):
        out: list[list] = [[], [], [], [], []]
        row, spans = batch.column(0), batch.column(1)
        texts = batch.column(2) if batch.num_columns > 2 else pc.struct_field(row, "text")
        begins, ends = (x.to_numpy() for x in spans.flatten().flatten())
        upto = np.cumsum(spans.value_lengths().fill_null(0).to_numpy())
        for text, a, b in zip(texts.fill_null("").to_pylist(), [0, *upto[:-1].tolist()], upto.tolist()):
            raw = text.encode()
            starts, stops = _united(begins[a:b], ends[a:b], len(raw)) if b > a else ([], [])
            kept = b"".join(raw[x:y] for x, y in zip([0, *stops], [*starts, len(raw)]))
            cells = len(raw), len(raw) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")
            for column, cell in zip(out, cells):
                column.append(cell)
        types = pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()
        yield pa.record_batch([row, *(pa.array(c, t) for c, t in zip(out, types))],
                              names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])


def without_repeats(documents: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """row (a record of the carried columns, doc_id if none are named), n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 of the bytes that stay, and text: their whole characters. One row per row."""
    spark = documents.sparkSession
    rows = documents.select(
        F.struct(*(carried or ["doc_id"])).alias("row"), "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("h1"), F.xxhash64(F.lit(1), F.coalesce("text", F.lit(""))).alias("h2"))
    # a row is known by its doc_id; where doc_ids repeat, by a hash of its text too
    unique = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    rows = rows.withColumn("digest", F.lit(0).cast("long") if unique else F.col("h1"))
    covered = stage_alone(spark, lambda: _covered(rows.select("doc", "text", "digest", "h1", "h2")), "covered")
    touched = may_be_in(bit_table(covered.select(F.xxhash64("doc"))), F.xxhash64("doc"), spark)
    has_text = "text" in rows.select("row.*").columns
    tied = rows.filter(touched).select("row", "doc", "digest", *[] if has_text else ["text"])
    tied = tied.join(covered, ["doc", "digest"], "left").select("row", "spans", *[] if has_text else ["text"])
    kind = rows.schema["row"].dataType.simpleString()
    cut = tied.mapInArrow(_cut, f"row {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")
    text, none = F.coalesce("text", F.lit("")), F.lit(0).cast("long")
    return cut.unionByName(rows.filter(~touched).select(
        "row", F.octet_length(text).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"), text.alias("text")))


def _covered(texts: DataFrame) -> DataFrame:
    """doc, digest and the spans to be cut of each document that has any (`texts`: doc, text, digest, h1, h2)."""
    spark = texts.sparkSession
    classes = texts.filter(F.octet_length("text") >= WINDOW).groupBy("h1", "h2").agg(
        F.min("doc").alias("original"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    classes = stage_table(classes, "copies")
    may_be_copy = may_be_in(bit_table(classes.select("h1")), F.col("h1"), spark)
    copies = texts.filter(may_be_copy).join(classes, ["h1", "h2"], "left")
    originals = texts.filter(~may_be_copy).drop("h1", "h2").unionByName(
        copies.filter("original is null or original = doc").select("doc", "text", "digest"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.lit(LAST).alias("b")))
    copied = copies.filter("original < doc").select("doc", "digest", whole.alias("spans")).distinct()

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = spark.sparkContext.broadcast(_anchor_bits(
        originals.select("doc", "text").mapInArrow(_documents_of_anchors(4 * tasks), "part int, anchors binary"), tasks))
    occurrences = originals.mapInArrow(_occurrences(bits), "anchor long, region long, doc long, digest long, pos long")
    occurrences = bucketed_table(occurrences, ["anchor", "region"], "occurrences")
    bits.destroy()
    spans = stage_alone(spark, lambda: _spans(texts, occurrences), "spans")
    covered = occurrences.join(spans, ["anchor", "region"]).filter("least < doc").groupBy("doc", "digest").agg(
        F.collect_set(F.struct((F.col("pos") + F.col("begin")).alias("a"), (F.col("pos") + F.col("end")).alias("b"))).alias("spans"))
    return covered.unionByName(copied)


def _spans(texts: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Spans of the regions of anchors that several documents have."""
    spark = texts.sparkSession
    regions = stage_alone(spark, lambda: _shared_regions(occurrences), "shared-regions")
    settled = regions.filter("n = 1").select(
        "anchor", "region", F.lit(-AROUND).cast("long").alias("begin"), F.lit(KEY + AROUND).cast("long").alias("end"),
        F.col("lo").alias("least"))
    common = regions.filter(F.col("n") > BLOCK)
    by_window = None if common.isEmpty() else stage_alone(spark, lambda: _spans_by_window(texts, common), "spans-by-window")
    by_order = _spans_by_order(texts, regions.filter((F.col("n") > 1) & (F.col("n") <= BLOCK)))
    spans = settled.unionByName(by_order)
    return spans if by_window is None else spans.unionByName(by_window)


def _shared_regions(occurrences: DataFrame) -> DataFrame:
    """The regions of anchors of several documents: their smallest and largest document, how many regions the anchor has,
    and if it has more than one, its smallest document and where the region's text is."""
    where = F.struct("doc", "digest", "pos")
    regions = occurrences.groupBy("anchor", "region").agg(F.min(where).alias("at"), F.max("doc").alias("hi"))
    regions = stage_table(regions.select("anchor", "region", F.col("at.doc").alias("lo"), "hi", "at"), "regions")
    met = regions.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("first"), F.max("hi").alias("last"))
    met = stage_table(met.filter("first < last").drop("last"), "shared-by-documents")
    several = [F.when(F.col("n") > 1, F.col(c)).alias(c) for c in ("first", "at")]
    return regions.join(met, "anchor").select("anchor", "region", "lo", "hi", "n", *several)


def _spans_by_order(texts: DataFrame, open_regions: DataFrame) -> DataFrame:
    """Spans of regions whose anchors have several, by suffix order within blocks."""
    columns = "bucket long, anchor long, region long, lo long, hi long, doc long, digest long, pos long, left long, bytes binary"
    fields = ["bucket", "anchor", "region", "lo", "hi", "doc", "digest", "pos"]

    def dealt() -> DataFrame:
        rows = open_regions.select("anchor", "region", "lo", "hi", "at.*", F.col("first").alias("block"))
        buckets = max(1, -(-rows.count() // BLOCK))
        parts = rows.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts")).filter("parts > 1")
        part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("anchor"), F.col("parts"))).otherwise(0)
        rows = rows.join(stage_table(parts, "large-blocks"), "block", "left")
        return _by_document(rows.withColumn("bucket", F.pmod(F.xxhash64("block", part), F.lit(buckets)).cast("long")), fields)

    def pieces() -> DataFrame:
        return _with_texts(texts, stage_alone(texts.sparkSession, dealt, "listed-regions")).mapInArrow(_region_texts, columns)

    return stage_alone(texts.sparkSession, pieces, "pieces").groupBy("bucket").applyInPandas(
        shared_spans, "anchor long, region long, begin long, end long, least long")


def _by_document(rows: DataFrame, fields: list[str]) -> DataFrame:
    """The list of the rows of each document that has any."""
    return rows.groupBy("doc", "digest").agg(F.collect_list(F.struct(*fields)).alias("regions"))


def _with_texts(texts: DataFrame, listed: DataFrame) -> DataFrame:
    """text, and the list of its document's rows, of documents that have any."""
    needed = may_be_in(bit_table(listed.select(F.xxhash64("doc"))), F.xxhash64("doc"), texts.sparkSession)
    return texts.select("doc", "digest", "text").filter(needed).join(listed, ["doc", "digest"]).select("text", "regions")


def _spans_by_window(texts: DataFrame, regions: DataFrame) -> DataFrame:
    """Spans of the regions of common anchors: each distinct window is a group of its own, over all tasks."""
    key, spark = ["anchor", "begin", "window"], texts.sparkSession

    def listed() -> DataFrame:
        return _by_document(regions.select("anchor", "region", "lo", "hi", "at.*"), ["anchor", "region", "lo", "hi", "pos"])

    def every_window() -> DataFrame:
        rows = _with_texts(texts, stage_alone(spark, listed, "listed-regions"))
        return rows.mapInArrow(_region_windows, "anchor long, region long, lo long, hi long, begin long, window long")

    windows = stage_alone(spark, every_window, "windows")
    classes = windows.groupBy(key).agg(F.min("lo").alias("least"), F.max("hi").alias("last"))
    classes = stage_table(classes.filter("least < last").drop("last"), "window-classes")
    may = may_be_in(bit_table(classes.select(F.xxhash64(*key)), bits_for(classes.count())), F.xxhash64(*key), spark)
    found = windows.filter(may).join(classes, key).filter("least < hi")
    # runs of windows with the same smallest document, within a region
    nth = F.dense_rank().over(Window.partitionBy("anchor", "region", "least").orderBy("begin"))
    runs = found.select("anchor", "region", "least", "begin", (F.col("begin") - nth).alias("run"))
    return runs.groupBy("anchor", "region", "least", "run").agg(F.min("begin").alias("begin"), (F.max("begin") + WINDOW).alias("end")).drop("run")
