"""Best-fit packing of tokenised documents into sequences of bounded length by a grouping genetic algorithm.

Documents become pieces: token ids with one separator id at the end, cut only where longer than a sequence. A piece
that fills a sequence is one. The others are packed in blocks of at most BLOCK pieces, dealt by a hash, so a block is a
fair sample of all lengths. For each block ISLANDS populations evolve apart. An individual is a grouping of the
block's pieces into bins. Crossover copies one parent, injects whole well-filled bins of the other, dissolves the bins
that hold a piece twice, and puts the displaced pieces back, largest first, where they fit best. After each epoch the
best individual of an island migrates to the next one. At the end bins that are not full enough are opened and their
pieces dealt into fewer blocks, level by level, until one block is left or a level gains nothing.

Only piece numbers and lengths move between tasks, never ids or texts; a group is one island of one block and so of
bounded size whatever the input. Everything is a function of piece numbers, so a task that runs again gives the same.

Defined results: a null or empty text is a document of the separator alone; repeated rows (also of one doc_id) are
documents of their own; columns besides doc_id and text are ignored; an empty table gives no rows. An individual
document longer than a sequence keeps its pieces' order by `piece` and `start`.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablespan.llm.common import stage_table, text_blocks
from tablespan.llm.words import word_tokenizer

LENGTH = 2048
SEPARATOR = 0
BLOCK = 2000               # pieces of one block
ISLANDS, EPOCHS = 2, 2
POPULATION, GENERATIONS = 3, 6
GOOD_FILL = 0.985          # bins at least so full are final; crossover injects such bins
LEVELS = 6

PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                   ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])


def tokenised_pieces(documents: DataFrame, tokenizer_file: str, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece (from 0), start, length, ids_crc32, and the ids themselves (array<int>) if asked for."""
    names = PIECE.names if keep_ids else PIECE.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer_file)
        for batch in text_blocks(batches):
            out: list[list] = [[] for _ in names]
            for doc, ids in zip(batch.column(0).to_pylist(), words.encoded(batch.column(1).fill_null("").to_pylist())):
                ids += SEPARATOR.to_bytes(4, "little")
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at:at + 4 * length]
                    cells = [doc, piece, at // 4, len(part) // 4, zlib.crc32(part)]
                    if keep_ids:
                        cells.append(np.frombuffer(part, "<i4"))
                    for column, cell in zip(out, cells):
                        column.append(cell)
            yield pa.record_batch([pa.array(c, PIECE.field(n).type) for n, c in zip(names, out)], names=names)

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


class Bins:
    """One grouping of a block: bins as lists of piece indices, their free room, and best-fit insertion through a bit
    set of the room values in use."""

    def __init__(self, sizes: list[int], length: int):
        self.sizes, self.length = sizes, length
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: list[list[int]] = [[] for _ in range(length + 1)]
        self.used = 0

    def insert(self, i: int) -> None:
        size = self.sizes[i]
        while True:
            fits = self.used >> size
            if not fits:
                b = len(self.bins)
                self.bins.append([i])
                self.room.append(self.length - size)
                break
            room = size + (fits & -fits).bit_length() - 1
            stack = self.by_room[room]
            b = stack.pop()
            if not stack:
                self.used &= ~(1 << room)
            if self.room[b] == room:
                self.bins[b].append(i)
                self.room[b] = room - size
                break
        self.offer(b)

    def offer(self, b: int) -> None:
        room = self.room[b]
        self.by_room[room].append(b)
        self.used |= 1 << room

    def add_whole(self, members: list[int]) -> None:
        self.bins.append(list(members))
        self.room.append(self.length - sum(map(self.sizes.__getitem__, members)))
        self.offer(len(self.bins) - 1)


def fitness(bins: list[list[int]], sizes: list[int], length: int) -> float:
    """Mean square of the fill: for equally many bins, full ones and one emptier one beat evenly filled ones."""
    return sum((sum(map(sizes.__getitem__, b)) / length) ** 2 for b in bins) / max(1, len(bins))


def best_fit(order, sizes: list[int], length: int, start: list[list[int]] = ()) -> list[list[int]]:
    packed = Bins(sizes, length)
    for members in start:
        packed.add_whole(members)
    for i in order:
        packed.insert(i)
    return packed.bins


def crossover(one: list[list[int]], other: list[list[int]], sizes: list[int], length: int, rng) -> list[list[int]]:
    """`one` with about half of the well-filled bins of `other` injected."""
    full = [b for b in other if sum(map(sizes.__getitem__, b)) >= GOOD_FILL * length]
    injected = [b for b, take in zip(full, rng.random(len(full)) < 0.5) if take]
    inside = set().union(*injected) if injected else set()
    kept, displaced = [], []
    for b in one:
        if inside.isdisjoint(b):
            kept.append(b)
        else:
            displaced += [i for i in b if i not in inside]
    # the emptiest bins left are opened too, which gives the displaced pieces partners
    kept.sort(key=lambda b: sum(map(sizes.__getitem__, b)))
    opened = max(1, len(kept) // 20)
    displaced += [i for b in kept[:opened] for i in b]
    displaced.sort(key=lambda i: (-sizes[i], i))
    return best_fit(displaced, sizes, length, [*injected, *kept[opened:]])


def evolve(sizes: list[int], length: int, seed: int, migrants: list[list[list[int]]]) -> list[list[list[int]]]:
    """The population after GENERATIONS, best first. It starts from the migrants and from best fit in disturbed
    orders of decreasing length."""
    rng = np.random.default_rng(seed)
    size = np.asarray(sizes)
    population = list(migrants)
    while len(population) < POPULATION:
        blur = rng.uniform(0, 0.15 * len(population) + 0.02 * (seed % 7), len(sizes))
        population.append(best_fit(np.argsort(-size * (1 - blur), kind="stable").tolist(), sizes, length))
    scored = sorted(((fitness(p, sizes, length), k, p) for k, p in enumerate(population)), reverse=True)
    least = -(-int(size.sum()) // length)
    for k in range(GENERATIONS):
        if len(scored[0][2]) <= least:
            break
        a, b = rng.choice(len(scored), 2, replace=False) if len(scored) > 1 else (0, 0)
        child = crossover(scored[min(a, b)][2], scored[max(a, b)][2], sizes, length, rng)
        scored = sorted([*scored, (fitness(child, sizes, length), 100 + k, child)], reverse=True)[:POPULATION]
    return [p for _, _, p in scored]


def _island(length: int, epoch: int):
    """Evolves one island of one block. Rows: block, island, item, length, bins (array: the item's bin in each
    migrant individual). Returns the same rows with the bins of the island's best individual."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("item", kind="stable")
        sizes = rows["length"].tolist()
        migrants = []
        for column in ("home", "guest"):
            if rows[column].min() >= 0:
                groups: dict[int, list[int]] = {}
                for i, b in enumerate(rows[column].tolist()):
                    groups.setdefault(b, []).append(i)
                migrants.append([groups[b] for b in sorted(groups)])
        seed = (int(rows["block"].iat[0]) * 31 + int(rows["island"].iat[0])) * 31 + epoch
        best = evolve(sizes, length, seed % (1 << 32), migrants)[0]
        bin_of = np.empty(len(sizes), np.int64)
        for b, members in enumerate(best):
            bin_of[members] = b
        return pd.DataFrame({"block": rows["block"], "island": rows["island"], "item": rows["item"], "length": rows["length"],
                             "home": bin_of, "guest": np.int64(-1), "score": fitness(best, sizes, length)})

    return run


_STATE = "block long, island int, item long, length long, home long, guest long, score double"


def _evolved(items: DataFrame, blocks: int, length: int) -> DataFrame:
    """block, item, length, bin: the best grouping of every block of items (item, length)."""
    islands = F.explode(F.array(*map(F.lit, range(ISLANDS))))
    nobody = F.lit(-1).cast("long")
    state = items.select(F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("long").alias("block"), islands.alias("island"), "item",
                         "length", nobody.alias("home"), nobody.alias("guest"))
    for epoch in range(EPOCHS):
        if epoch:  # each best individual stays, and goes to the next island as a guest
            stays = F.struct("island", "home", nobody.alias("guest"))
            goes = F.struct(((F.col("island") + 1) % ISLANDS).alias("island"), nobody.alias("home"), F.col("home").alias("guest"))
            state = state.select("block", "item", "length", F.inline(F.array(stays, goes))).groupBy(
                "block", "island", "item", "length").agg(F.max("home").alias("home"), F.max("guest").alias("guest"))
        state = state.groupBy("block", "island").applyInPandas(_island(length, epoch), _STATE)
    best = F.max_by(F.col("home"), F.struct("score", -F.col("island")))
    return state.groupBy("block", "item", "length").agg(best.alias("bin"))


def packed(pieces: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """`pieces` with sequence_id (any numbers) and offset. Lengths are from 1 to `length`."""
    numbered = stage_table(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    whole = numbered.filter(F.col("length") >= length).select("item", (-1 - F.col("item")).alias("sequence_id"))
    rest = numbered.filter(F.col("length") < length).select("item", "length")
    done, n = [whole], rest.count()
    for level in range(LEVELS):
        if n == 0:
            break
        blocks = -(-n // block)
        groups = stage_table(_evolved(rest, blocks, length), "packed-level")
        # level, block and bin in one number: a block has at most as many bins as pieces, about BLOCK of them
        sequence = F.lit(level << 59) + F.col("block") * F.lit(1 << 16) + F.col("bin")
        fill = groups.groupBy("block", "bin").agg(F.sum("length").alias("fill"))
        full = fill.filter(F.col("fill") >= int(GOOD_FILL * length)).select("block", "bin")
        poor = groups.join(full, ["block", "bin"], "left_anti")
        before, n = n, poor.count()
        if blocks == 1 or level == LEVELS - 1 or n > 0.9 * before:
            done.append(groups.select("item", sequence.alias("sequence_id")))
            break
        done.append(groups.join(full, ["block", "bin"], "left_semi").select("item", sequence.alias("sequence_id")))
        rest = poor.select("item", "length")
    bins = done[0]
    for more in done[1:]:
        bins = bins.unionByName(more)
    before_it = Window.partitionBy("sequence_id").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.join(bins, "item").withColumn("offset", F.coalesce(F.sum("length").over(before_it), F.lit(0))).drop("item")


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """sequence_id and its token ids, from packed pieces that kept their ids. A sequence is of bounded length."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed_pieces.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
