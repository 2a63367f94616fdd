"""N-gram Jaccard join by a token-group matrix: exact links between documents with similar shingle sets, and components.

1. Documents with the same shingle set are one node, whatever their number.
2. Nodes are partitioned into groups of connected ones. Every node has MIN_HASHES min-hashes; among those that have one in
   common the head is the node whose tokens are the most common ones, so of many copies with changes of their own the
   least changed, and the others' similarity to it is verified. Of its verified heads a node follows the one with the
   most common tokens, to that one's own head if it has any; nodes that end at the same head are a group. So a copy is
   left alone only if it misses the heads under all its min-hashes. The verified links between groups are kept for 5.
3. The token-group matrix holds, for each group (in chunks of about CHUNK members), the union of its members' tokens.
   Its sparse index keeps the tokens of the members' prefixes: ordered from rare to common, two sets as similar as
   asked for share k of their first |X| - ceil(s |X|) + k tokens; k grows with the sets (`_spare`). Tokens are counted
   alone first; those of one node only, most of all, never travel with it, nor does a node left with fewer than k. Two groups that
   share so many index tokens and whose sizes allow a link are a candidate pair. Copies that differ from one and the same
   head up to twice as much as linked ones meet through their differences from it instead (`_same_head_pairs`): linked
   copies must share many of those, copies with changes of their own share few. So do they meet the members of that
   head's group, one by one and not in chunks (`_links_to_members`).
4. A member of the smaller group is a query against each chunk of the other: the chunk opens only if the query shares
   at least s |query| tokens with the chunk's union. Members of opened chunks are verified one by one on their sets.
5. Components of verified links, each named by its smallest doc_id.

The order of tokens comes from a table of COUNTERS counters over all documents. It decides only which tokens count as
rare, so collisions cost candidates but no links, and its size does not grow with the data. A token or passage that a
third of all documents share counts as common, so it stands last and takes no part in candidate search; many near
copies of one document are one group and meet other groups once, not once per copy. Sets and pairs are joined by
plain joins, which may be split where a key is frequent.

Tokens are 64-bit hashes of shingles. Defined results: a null or empty text, or one without words, has an empty set and
is linked with nothing; fewer words than the shingle's width make one shingle of all; repeated rows, also of one doc_id
with different texts, are judged row by row and share a component if linked; columns besides doc_id and text are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablespan.llm.common import bit_table, has_bit, may_be_in, stage_alone, stage_table, text_blocks
from tablespan.llm.components import components
from tablespan.llm.shingles import mix, shingle_sets

COUNTERS = 1 << 18
CHUNK = 64

#: A copy as similar to its head as asked for has another min-hash than the head in at most 15 of 100 cases (percent = 85).
MIN_HASHES = 4

_SETS = "doc_id long, hash long, n_shingles long, d1 long, d2 long, keys array<long>, counts binary"
#: Stands for a null doc_id.
LAST = (1 << 63) - 1


def _digests(tokens: np.ndarray) -> tuple[int, int, list[int]]:
    """Two order-free digests of a set, and its min-hashes."""
    a, b = mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), mix(tokens ^ np.uint64(0x14057B7EF767814F))
    one, two, *keys = (int(x.astype(np.int64)) for x in (
        a.sum(dtype=np.uint64), b.sum(dtype=np.uint64), *(h.min() for h in (a, b, a ^ b, a + b)[:MIN_HASHES])))
    return one, two, keys


def _summaries(width: int):
    """One row per document, and per task one row with its token counters."""
    names = [c.split()[0] for c in _SETS.split(", ")]
    kinds = [pa.int64()] * 2 + [pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in text_blocks(batches):
            sets = shingle_sets(batch.column(1), width)
            counts += np.bincount(np.concatenate(sets).astype(np.int64) & (COUNTERS - 1), minlength=COUNTERS)
            found = [_digests(t) if len(t) else (0, 0, []) for t in sets]
            columns = [batch.column(0), batch.column(2), pa.array([len(t) for t in sets], pa.int64()),
                       *[pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], pa.nulls(len(sets), pa.binary())]
            yield pa.record_batch(columns, names=names)
        nothing = pa.nulls(1, pa.int64())
        yield pa.record_batch([nothing] * 5 + [pa.nulls(1, kinds[-1]), pa.array([counts.tobytes()], pa.binary())], names=names)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for row in batch.column(0):
            total += np.frombuffer(row.as_py(), np.int64)
    yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["counts"])


def _counters(summaries: DataFrame) -> np.ndarray:
    """The counters of all tasks, added in two shuffles: of N tables no task reads more than about the square root of N."""
    rows = summaries.filter("counts is not null").select("counts")
    middle = max(1, int(rows.count() ** 0.5))
    row = rows.repartition(middle).mapInArrow(_added, "counts binary").repartition(1).mapInArrow(_added, "counts binary").first()
    return np.frombuffer(bytes(row.counts), np.int64)


def _spare(n: int) -> int:
    """Tokens that two sets share at least in their prefixes; a prefix is longer by as many. More than one, so that a
    short common passage makes no candidates."""
    return 1 + n // 20


def _only_nodes(batch: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch:
    """The rows (doc_id, text, hash, row_hash) that may stand for a node."""
    return batch.filter(pa.array(has_bit(bits, batch.column(3).to_numpy())))


def _prefix(tokens: np.ndarray, percent: int, counts: np.ndarray) -> np.ndarray:
    """The prefix of a set, from rare to common."""
    n = len(tokens)
    order = np.lexsort((tokens, counts[tokens.astype(np.int64) & (COUNTERS - 1)]))
    return tokens[order[:n + (-n * percent // 100) + _spare(n)]]


def _rank(token: np.uint64, counts: np.ndarray) -> int:
    """Ascends, not strictly, with the place of a token among all."""
    return int(counts[int(token) & (COUNTERS - 1)]) << 24 | int(token) >> 40


def _prefix_tokens(width: int, percent: int, counts: np.ndarray, chosen: np.ndarray):
    """All prefix tokens of the nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            batch = _only_nodes(batch, chosen)
            found = [_prefix(t, percent, counts) for t in shingle_sets(batch.column(1), width) if len(t)]
            if found:
                yield pa.record_batch([pa.array(np.concatenate(found).view(np.int64))], names=["token"])

    return run


def _prefix_lists(width: int, percent: int, counts: np.ndarray, chosen: np.ndarray, shared: np.ndarray):
    """doc_id, d1 and those prefix tokens that other nodes may have too, with their places in the prefix. What stands before
    a token and is no other node's cannot be in a set that has the token in its prefix: it would stand there too. So a
    set linked through the token has at most the rest of this one; a token that leaves too few for any link is dropped.
    A node with fewer tokens than any set it may be linked with must share has no link and gives no row. `rest` is what
    is left of the set without all such tokens of its prefix, `last` the rank of where the prefix ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            batch = _only_nodes(batch, chosen)
            out: list[list] = [[], [], [], [], [], []]
            for tokens, doc in zip(shingle_sets(batch.column(1), width), batch.column(0).to_pylist()):
                if len(tokens) == 0:
                    continue
                n, prefix = len(tokens), _prefix(tokens, percent, counts)
                places = np.flatnonzero(has_bit(shared, prefix))
                rest = n - len(prefix) + len(places)
                places = places[100 * (np.arange(len(places)) + n - places) >= percent * n]
                if len(places) >= _spare(-(-n * percent // 100)):
                    cells = doc, _digests(tokens)[0], prefix[places].view(np.int64), places, rest, _rank(prefix[-1], counts)
                    for column, cell in zip(out, cells):
                        column.append(cell)
            types = pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.int64()
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types)], names=["doc_id", "d1", "prefix", "places", "rest", "last"])

    return run


def _whole_sets(width: int, counts: np.ndarray, chosen: np.ndarray, bits: np.ndarray):
    """doc_id, d1, the whole set of nodes with the bit of their first digest set, and how common its tokens are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            batch = _only_nodes(batch, chosen)
            out: list[list] = [[], [], [], []]
            for tokens, doc in zip(shingle_sets(batch.column(1), width), batch.column(0).to_pylist()):
                if len(tokens) == 0:
                    continue
                digest = _digests(tokens)[0]
                if has_bit(bits, np.array([digest]))[0]:
                    common = float(np.log1p(counts[tokens.astype(np.int64) & (COUNTERS - 1)]).mean())
                    for column, cell in zip(out, (doc, digest, tokens.view(np.int64), common)):
                        column.append(cell)
            types = pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.float64()
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types)], names=["doc_id", "d1", "tokens", "common"])

    return run


def _of_nodes(lists: DataFrame, nodes: DataFrame, label: str) -> DataFrame:
    """The row of `lists` (doc_id, d1, a list) of each of `nodes` (doc, d1, repeated and others, all kept)."""
    found = stage_table(nodes.withColumnRenamed("doc", "doc_id").join(lists, ["doc_id", "d1"]), label)
    once, often = found.filter("not repeated"), found.filter("repeated")
    return once.unionByName(often.dropDuplicates(["node"]))


def _sets_of(texts: DataFrame, nodes: DataFrame, width: int, counts: np.ndarray, chosen: np.ndarray) -> DataFrame:
    """The whole sets of `nodes`, which is a table, not a plan."""
    lists = texts.mapInArrow(_whole_sets(width, counts, chosen, bit_table(nodes.select("d1"))),
                             "doc_id long, d1 long, tokens array<long>, common double")
    return _of_nodes(lists, nodes, "tokens")


def _only(rows: DataFrame, wanted: DataFrame, of: str = "node") -> DataFrame:
    """The rows whose node may be in column `of` of `wanted`, a table, so that sets nobody asks for are not shuffled."""
    return rows.filter(may_be_in(bit_table(wanted.select(F.xxhash64(of))), F.xxhash64("node"), rows.sparkSession))


def _similar(a: Column, b: Column, percent: int) -> Column:
    common = F.size(F.array_intersect(a, b))
    return 100 * common >= percent * (F.size(a) + F.size(b) - common)


def _alike(nodes: DataFrame) -> DataFrame:
    """node and key, a min-hash with its number, for every key that several nodes have."""
    keyed = nodes.select("node", F.posexplode("keys")).select("node", F.xxhash64("pos", "col").alias("key"))
    several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    return stage_table(keyed.join(several, "key"), "alike")


def _met_heads(alike: DataFrame, sizes: DataFrame, wholes: DataFrame, percent: int) -> DataFrame:
    """node, a head under its keys, the head's `common`, whether the two are similar, and whether they would be if sets
    might lie twice as far apart. Heads whose size alone rules both out are left out. `sizes`: node, n_shingles."""
    heads = alike.join(wholes.select("node", "common"), "node").groupBy("key").agg(F.max(F.struct("common", "node")).alias("best"))
    to_head = alike.join(heads.select("key", "best.common", F.col("best.node").alias("head")), "key").filter("node <> head")
    pairs = to_head.select("node", "head", "common").distinct().join(sizes.withColumnRenamed("n_shingles", "n"), "node").join(
        sizes.select(F.col("node").alias("head"), F.col("n_shingles").alias("m")), "head")
    far = max(0, 2 * percent - 100)
    pairs = stage_table(pairs.filter(100 * F.least("n", "m") >= far * F.greatest("n", "m")).drop("n", "m"), "head-pairs")
    firsts = _only(wholes, pairs, "head").select(F.col("node").alias("head"), F.col("tokens").alias("first"))
    met = pairs.join(_only(wholes, pairs).select("node", "tokens"), "node").join(firsts, "head")
    similar, near = (_similar(F.col("tokens"), F.col("first"), p) for p in (percent, far))
    return met.select("node", "head", "common", similar.alias("similar"), near.alias("near"))


def _ends(stars: DataFrame) -> DataFrame:
    """node and grp: the head of the head that a node follows, or that head itself if it follows none. Heads that others
    follow and that follow none are their own."""
    follows = stage_table(stars.groupBy("node").agg(F.max(F.struct("common", "head")).alias("best")).select("node", "best.head"), "follows")
    onward = follows.select(F.col("node").alias("head"), F.col("head").alias("end"))
    return follows.join(onward, "head", "left").select("node", F.coalesce("end", "head").alias("grp"))


def linked_components(documents: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, for every row; also hash (of the text)
    and root, which tells components apart where doc_ids repeat (null without words)."""
    texts = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), "text",
                             F.coalesce(F.xxhash64("text"), F.lit(0)).alias("hash"))
    texts = texts.withColumn("row_hash", F.xxhash64("doc_id", "hash"))
    summaries = stage_table(texts.mapInArrow(_summaries(width), _SETS), "shingle-sets")
    counts = _counters(summaries)
    rows = summaries.filter("counts is null").drop("counts")
    digest = ["n_shingles", "d1", "d2"]
    nodes = rows.filter("n_shingles > 0").groupBy(*digest, "doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.first("keys").alias("keys"), F.min("hash").alias("hash")).groupBy(*digest).agg(
        F.min("doc_id").alias("doc"), F.min_by(F.col("rows") > 1, "doc_id").alias("repeated"), F.first("keys").alias("keys"),
        F.min_by("hash", "doc_id").alias("hash"))
    nodes = stage_table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    chosen = bit_table(nodes.select(F.xxhash64("doc", "hash")))
    alike = _alike(nodes)
    known = stage_table(nodes.join(alike, "node", "left_semi").select("node", "doc", "d1", "repeated"), "known")
    wholes = _sets_of(texts, known, width, counts, chosen)
    nodes = nodes.drop("keys", "hash")
    met = stage_table(_met_heads(alike, nodes.select("node", "n_shingles"), wholes, percent), "met-heads")
    stars = met.filter("similar")
    ends = _ends(stars)
    grouped = nodes.join(ends, "node", "left").select("node", "n_shingles", F.coalesce("grp", "node").alias("grp"))
    grouped = stage_table(grouped, "groups")
    end_of = grouped.select(F.col("node").alias("head"), F.col("grp").alias("b"))
    known_links = stars.join(grouped, "node").join(end_of, "head").select(F.col("grp").alias("a"), "b").filter("a <> b").distinct()

    seen = texts.mapInArrow(_prefix_tokens(width, percent, counts, chosen), "token long")
    seen = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("token")
    shared = bit_table(stage_table(seen, "shared-tokens"))
    lists = texts.mapInArrow(_prefix_lists(width, percent, counts, chosen, shared), "doc_id long, d1 long, prefix array<long>, places array<int>, rest int, last long")
    prefixes = _of_nodes(lists, nodes.select("node", "doc", "d1", "repeated"), "prefixes").select("node", "prefix", "places", "rest", "last")
    alone = grouped.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select(F.col("grp").alias("node"))
    refs = met.filter("near and not similar").groupBy("node").agg(F.max_by("head", F.struct("common", "head")).alias("ref"))
    refs = stage_table(refs.join(alone, "node"), "refs")
    differences = _differences(refs, grouped, wholes, percent)
    pairs = _candidate_groups(grouped, prefixes, percent, refs).unionByName(_same_head_pairs(differences, percent))
    pairs = stage_table(pairs, "group-pairs")
    links = _links_between(texts, nodes, grouped, wholes.select("node", "tokens"), pairs, width, percent, counts, chosen)
    roots = components(links.unionByName(known_links).unionByName(_links_to_members(differences, wholes, percent)))
    named = grouped.join(roots, grouped.grp == roots.node, "left").select(grouped.node, F.coalesce("root", "grp").alias("root"))
    named = named.join(nodes, "node").select("root", "doc", *digest)
    smallest = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = named.join(smallest, "root").select(*digest, "root", "component_id")
    found = rows.join(named, digest, "left")
    real = [F.when(c < LAST, c).alias(name) for name, c in (
        ("doc_id", F.col("doc_id")), ("component_id", F.coalesce("component_id", "doc_id")))]
    return found.select(real[0], "hash", "root", "n_shingles", real[1])


def written_components(documents: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """`linked_components`, written, without the tables staged on the way, which would stay until the session ends."""
    return stage_alone(documents.sparkSession, lambda: linked_components(documents, width, percent), "linked")


def one_of_each(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest doc_id, and of several such
    rows one. Documents without words are linked with nothing and stay, one for each doc_id and text."""
    found = written_components(documents, width, percent).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = found.groupBy("doc_id", F.coalesce("root", "hash"), F.col("root").isNull()).agg(F.min("hash").alias("hash"))
    first = first.select(F.coalesce("doc_id", F.lit(LAST)).alias("d"), F.col("hash").alias("h"))
    rows = documents.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"),
                            F.coalesce(F.xxhash64("text"), F.lit(0)).alias("h"))
    return rows.join(first, ["d", "h"]).dropDuplicates(["d", "h"]).select("row.*")


def _links_between(texts: DataFrame, nodes: DataFrame, grouped: DataFrame, wholes: DataFrame, pairs: DataFrame, width: int,
                   percent: int, counts: np.ndarray, chosen: np.ndarray) -> DataFrame:
    """Edges (a, b) between groups that have similar members. `wholes` has the sets that are known already."""
    involved = pairs.select(F.explode(F.array("asks", "holds")).alias("grp")).distinct()
    members = stage_table(grouped.join(involved, "grp", "left_semi"), "involved")
    missing = members.join(wholes.select("node"), "node", "left_anti").select("node").join(nodes, "node")
    missing = stage_table(missing.select("node", "doc", "d1", "repeated"), "missing")
    more = _sets_of(texts, missing, width, counts, chosen).select("node", "tokens")
    have = _only(wholes, members).unionByName(more)
    chunks = grouped.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    members = members.join(chunks, "grp").join(have, "node").select(
        "grp", F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"), "node", "tokens")
    members = stage_table(members, "members")

    matrix = members.groupBy("grp", "chunk").agg(F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union"))
    queries = members.select(F.col("grp").alias("asks"), F.col("node").alias("query"), F.col("tokens").alias("asked"))
    opened = pairs.join(queries, "asks").join(matrix, F.col("holds") == F.col("grp")).filter(
        100 * F.size(F.array_intersect("asked", "union")) >= percent * F.size("asked")).select("asks", "query", "grp", "chunk")
    opened = stage_table(opened, "opened")
    held = opened.join(members, ["grp", "chunk"]).select("asks", "query", "grp", "tokens")
    asked = members.select(F.col("node").alias("query"), F.col("tokens").alias("asked"))
    return held.join(asked, "query").filter(_similar(F.col("tokens"), F.col("asked"), percent)).select(
        F.col("asks").alias("a"), F.col("grp").alias("b")).distinct()


def _differences(refs: DataFrame, grouped: DataFrame, wholes: DataFrame, percent: int) -> DataFrame:
    """The differences from a common head that may be shared, for nodes that have the same head and are not similar to it
    (`far`, `refs`: node, ref) and for the members of that head's group: ref, token, side, node, its size n, the number d of
    its differences, its place among them from rare to common, what may be shared before and after it, and `early`:
    whether it may be the first one that linked sets share, of two far ones or of a member and a far one. Two sets differ
    in what their differences from a third one differ in. Linked sets a and b differ in at most r (|a| + |b|) tokens, with
    r = (100 - percent) / (100 + percent), and a far one from the head in more than r (|a| + |head|). So two far ones have
    more than r |head| differences in common, and a far one shares with a member b more than half of what b differs in
    from the head plus r (|head| - |b|)."""
    members = grouped.join(refs.select(F.col("ref").alias("grp")).distinct(), "grp").filter("node <> grp").select(
        "node", F.col("grp").alias("ref"))
    compared = refs.withColumn("far", F.lit(True)).unionByName(members.withColumn("far", F.lit(False)))
    compared = stage_table(compared, "compared")
    firsts = _only(wholes, refs, "ref").select(F.col("node").alias("ref"), F.col("tokens").alias("first"))
    both = compared.join(_only(wholes, compared).select("node", "tokens"), "node").join(firsts, "ref")
    own, gone = F.array_except("tokens", "first"), F.array_except("first", "tokens")
    differ = [F.transform(own, lambda t: F.struct(t.alias("token"), F.lit(0).alias("side"))),
              F.transform(gone, lambda t: F.struct(t.alias("token"), F.lit(1).alias("side")))]
    both = both.select("node", "ref", "far", F.size("tokens").alias("n"), F.size("first").alias("m"), F.concat(*differ).alias("differ"))
    least = F.when(F.col("far"), (100 - percent) * F.col("m") / (100 + percent)).otherwise(
        ((100 + percent) * F.size("differ") + (100 - percent) * (F.col("m") - F.col("n"))) / (2 * (100 + percent)))
    need = F.floor(least).cast("int") + 1
    rows = both.select("node", "ref", "far", "n", F.size("differ").alias("d"), need.alias("need"), F.inline("differ"))
    rows = stage_table(rows, "differences")
    key = ["ref", "token", "side"]
    rows = rows.join(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("often")), key)
    order = Window.partitionBy("node", "ref").orderBy("often", "side", "token")
    rows = rows.withColumn("place", F.row_number().over(order) - 1).withColumn(
        "before", F.sum((F.col("often") > 1).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("early", F.col("place") <= F.col("d") - F.col("need")).filter("often > 1 and (far or early)")
    rows = rows.select(*key, "node", "far", "n", "d", "early", F.coalesce("before", F.lit(0)).alias("before"),
                       (F.col("d") - F.col("place") - 1).alias("after"))
    return stage_table(rows, "rare-differences")


def _sharing(a: DataFrame, b: DataFrame, percent: int, *also: Column) -> DataFrame:
    """Each pair of rows of `_differences` (a, b) that may be the first difference which linked sets share."""
    common = F.least("a.before", "b.before") + 1 + F.least("a.after", "b.after")
    fits = (100 + percent) * (F.col("a.d") + F.col("b.d") - 2 * common) <= (100 - percent) * (F.col("a.n") + F.col("b.n"))
    for condition in (*(F.col(f"a.{name}") == F.col(f"b.{name}") for name in ("ref", "token", "side")), *also):
        fits &= condition
    return a.alias("a").join(b.alias("b"), fits)


def _same_head_pairs(differences: DataFrame, percent: int) -> DataFrame:
    """Pairs (asks, holds) of far nodes of the same head that may have a link."""
    rows = differences.filter("far and early")
    return _sharing(rows, rows, percent, F.col("a.node") < F.col("b.node")).select(
        F.col("a.node").alias("asks"), F.col("b.node").alias("holds")).distinct()


def _links_to_members(differences: DataFrame, wholes: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between far nodes and the group of their head, where a member of it is similar."""
    met = _sharing(differences.filter("far"), differences.filter("not far"), percent).select(
        F.col("a.node").alias("node"), F.col("b.node").alias("member"), F.col("a.ref").alias("ref")).distinct()
    met = stage_table(met, "met-members")
    members = _only(wholes, met, "member").select(F.col("node").alias("member"), F.col("tokens").alias("held"))
    both = met.join(_only(wholes, met).select("node", "tokens"), "node").join(members, "member")
    return both.filter(_similar(F.col("tokens"), F.col("held"), percent)).select(F.col("node").alias("a"), F.col("ref").alias("b")).distinct()


def _candidate_groups(grouped: DataFrame, prefixes: DataFrame, percent: int, refs: DataFrame) -> DataFrame:
    """Pairs of groups that share an index token: asks (the one with fewer members) and holds. With a token come the most
    tokens that a member may share with another set before and after it. All common index tokens of linked sets leave
    room for a link; a pair that does not get it from a token, such as copies with many changes of their own, does not meet
    there, nor do two with the same head in `refs` or one with its head's group. Tokens of a group of one are distinct already and are not shuffled to
    merge them. The index is written, so that joining it with itself shuffles it once."""
    members = grouped.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    prefixes = prefixes.join(grouped, "node").join(members, "grp").join(refs, "node", "left")
    size = F.col("n_shingles")
    token = F.transform("prefix", lambda t, k: F.struct(
        t.alias("token"), k.alias("before"), (size - F.get("places", k) - 1).cast("int").alias("after")))
    tokens = prefixes.select("grp", "n", "n_shingles", "rest", "last", "ref", F.inline(token))
    alone = tokens.filter("n = 1").select("token", "grp", size.alias("least"), size.alias("most"), "before", "after", "rest", "last", "ref")
    union = tokens.filter("n > 1").groupBy("token", "grp").agg(
        F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"), F.max("before").alias("before"), F.max("after").alias("after"),
        F.max("n_shingles").cast("int").alias("rest"), F.max("last").alias("last"),
        F.lit(None).cast("long").alias("ref"))
    index = stage_table(alone.unionByName(union), "group-tokens")
    pairs = _meeting(index, percent).groupBy(F.col("a.grp").alias("g"), F.col("b.grp").alias("h")).agg(F.count(F.lit(1)).alias("shared"))
    sizes = grouped.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("n_shingles").alias("m"))
    one, two = (sizes.select(F.col("grp").alias(x), F.col("n").alias(f"n_{x}"), F.col("m").alias(f"m_{x}")) for x in "gh")
    fewer = F.col("n_g") <= F.col("n_h")
    enough = F.col("shared") >= 1 + F.floor(F.least("m_g", "m_h") / 20)
    return pairs.join(one, "g").join(two, "h").filter(enough).select(
        F.when(fewer, F.col("g")).otherwise(F.col("h")).alias("asks"), F.when(fewer, F.col("h")).otherwise(F.col("g")).alias("holds"))


def _meeting(index: DataFrame, percent: int) -> DataFrame:
    """Each pair of rows of the index (a, b) whose groups may have a link through their token. Of two sets the one whose
    prefix ends first shares no more than its `rest`: what no other node has in its prefix would stand in the other
    one's prefix too. With equal ranks it is not known which ends first. For a group of several, `rest` is no bound."""
    a, b = index.alias("a"), index.alias("b")
    rest = F.when(F.col("a.last") < F.col("b.last"), F.col("a.rest")).when(
        F.col("a.last") > F.col("b.last"), F.col("b.rest")).otherwise(F.greatest("a.rest", "b.rest"))
    common = F.least(F.least("a.before", "b.before") + 1 + F.least("a.after", "b.after"), rest)
    fits = (F.col("a.grp") < F.col("b.grp")) & (percent * F.col("a.least") <= 100 * F.col("b.most")) & (
        percent * F.col("b.least") <= 100 * F.col("a.most")) & (
        100 * common >= percent * (F.col("a.least") + F.col("b.least") - common)) & (
        F.col("a.ref").isNull() | F.col("b.ref").isNull() | (F.col("a.ref") != F.col("b.ref"))) & (
        F.col("a.ref").isNull() | (F.col("a.ref") != F.col("b.grp"))) & (
        F.col("b.ref").isNull() | (F.col("b.ref") != F.col("a.grp")))
    return a.join(b, (F.col("a.token") == F.col("b.token")) & fits)
