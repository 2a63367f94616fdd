"""Trees stored as parent keys: levels, paths, depth-first listing, descendants.

`walk` makes one join per level between the newest nodes and the edge table. Each level is written to the
shared folder, so lineage stays short and the next join knows the true size of its small side. The
number of levels bounds the loop; the number of nodes does not matter. It suits trees of few levels.

`levels` and `depth_first` suit deep ones: pointers are doubled, so the rounds grow with the logarithm of the depth, or of the
number of nodes, and no path is kept in a row."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from tablespan.operators.ordinals import running_total
from tablespan.scratch import new_path, written_table


def _step(c: Column) -> Column:
    """A path step that sorts as the id does, whatever its length: negative numbers, then by the text
    before the first digit and the number that follows, so C9 comes before C10."""
    text = c.cast("string")
    number = F.regexp_replace(F.regexp_extract(text, r"^\D*(\d*)", 1), "^0+(?=.)", "")
    negative = text.rlike(r"^-\d+$")
    size = F.when(negative, -F.length(number)).otherwise(F.length(number))
    digits = F.when(negative, F.translate(number, "0123456789", "9876543210")).otherwise(number)
    prefix = F.when(negative, "").otherwise(F.regexp_extract(text, r"^\D*", 0))
    return F.struct(prefix.alias("prefix"), size.alias("size"), digits.alias("digits"), text.alias("id"))


def walk(nodes: DataFrame, node: str, parent: str, roots: Column | None = None,
         child_condition: Column | None = None, max_levels: int | None = None) -> DataFrame:
    """All nodes reachable from the roots (default: nodes without parent), with `level` from 1,
    `path` (ids from the root) and `sort_path`, by which ordering is depth first. The extra
    condition applies to child rows only, not to roots. A node met again on its own path, as in a
    cycle, is not entered, so the walk ends by itself; `max_levels` makes a deeper tree an error."""
    spark = nodes.sparkSession
    folder = new_path(spark, "levels")
    start = nodes.where(F.col(parent).isNull() if roots is None else roots)
    level = start.select(
        *nodes.columns, F.lit(1).alias("level"), F.array(F.col(node).cast("string")).alias("path"),
        F.array(_step(F.col(node))).alias("sort_path"))
    # the edges are computed once, not once per level
    below = written_table(nodes if child_condition is None else nodes.where(child_condition), "edges")
    paths = []
    for number in count(1):
        if max_levels is not None and number > max_levels + 1:
            raise ValueError(f"the tree is deeper than {max_levels} levels")
        path = f"{folder}/level={number}"
        level.write.parquet(path)
        current = spark.read.schema(level.schema).parquet(path)
        if current.isEmpty():
            break
        paths.append(current)
        upper = current.select(F.col(node).alias("_up"), "level", F.col("path").alias("_path"),
                               F.col("sort_path").alias("_sort"))
        level = (below.join(upper, F.col(parent) == F.col("_up"))
                 .where(~F.array_contains("_path", F.col(node).cast("string")))
                 .select(*nodes.columns, (F.col("level") + 1).alias("level"),
                         F.array_append("_path", F.col(node).cast("string")).alias("path"),
                         F.array_append("_sort", _step(F.col(node))).alias("sort_path")))
    if not paths:
        return level.limit(0)
    tree = paths[0]
    for more in paths[1:]:
        tree = tree.unionByName(more)
    return tree


def indented(label: Column, first: str = "-", step: str = "--") -> Column:
    """A listing line whose prefix grows by `step` per level."""
    return F.concat(F.lit(first), F.expr(f"repeat('{step}', level - 1)"), F.lit(" "), label)


# ---------------------------------------------------------------- deep trees

def chained(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (id, next, amount) with unique ids, where `next` is NULL at the end of a chain: (id, end, total), the last id of each
    one's chain and the sum of amounts up to and including it; and the ids (id) whose chain has no end, because it runs into
    a cycle. Ids whose chain leads to an id that is not there are in neither.

    Each round joins every open pointer to what its target knows, which doubles the length it spans; finished ids are
    written once and only looked up afterwards. After 2 ** rounds >= number of ids nothing but cycles is open."""
    spark = links.sparkSession
    rows = links.select("id", "next", F.when(F.col("next").isNull(), F.col("id")).alias("end"), F.col("amount").alias("total"))
    folder, earlier, span = new_path(spark, "chains"), [], 1
    scan = lambda numbers: spark.read.schema(rows.schema).parquet(*[f"{folder}/{k}" for k in numbers])
    rows.write.parquet(f"{folder}/0")
    n = scan([0]).count()
    for number in count(1):
        newest = scan([number - 1])
        open_ids = newest.where("next is not null")
        if span > n or open_ids.isEmpty():
            break
        # what earlier rounds finished lies in their folders, beside rows that later rounds have moved on
        known = newest.unionByName(scan(earlier).where("next is null")) if earlier else newest
        known = known.select(F.col("id").alias("_id"), F.col("next").alias("_next"), F.col("end").alias("_end"), F.col("total").alias("_total"))
        open_ids.join(known, F.col("next") == F.col("_id")).select(
            "id", F.col("_next").alias("next"), F.col("_end").alias("end"), (F.col("total") + F.col("_total")).alias("total")
        ).write.parquet(f"{folder}/{number}")
        earlier, span = [*earlier, number - 1], 2 * span
    return scan([*earlier, number - 1]).where("next is null").select("id", "end", "total"), open_ids.select("id")


def levels(nodes: DataFrame, node: str, parent: str, roots: Column | None = None,
           child_condition: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """All nodes reachable from the roots (default: nodes without parent), with `level` from 1 and `root`; and the nodes
    (`node`) on a cycle or below one. Ids must be unique. The extra condition applies to child rows only."""
    is_root = F.coalesce(F.col(parent).isNull() if roots is None else roots, F.lit(False))
    is_child = F.col(parent).isNotNull() & (F.lit(True) if child_condition is None else F.coalesce(child_condition, F.lit(False)))
    links = nodes.where(is_root | is_child).select(
        F.col(node).alias("id"), F.when(~is_root, F.col(parent)).alias("next"), F.lit(1).cast("long").alias("amount"))
    found, cyclic = chained(links)
    found = found.select(F.col("id").alias("_id"), F.col("total").alias("level"), F.col("end").alias("root"))
    return nodes.join(found, F.col(node) == F.col("_id")).drop("_id"), cyclic.select(F.col("id").alias(node))


def depth_first(tree: DataFrame, node: str, parent: str, order: list[str], name: str = "listed_as", levelled: bool = False) -> DataFrame:
    """Add each node's number, from 1, in a depth-first listing whose siblings, and roots, come in `order`. A node whose parent
    is not in the table is a root. Say `levelled` where `tree` is what `levels` returned, with its `level` and `root`: they
    need not be found again then.

    Nodes that are the only children of theirs follow them in any order, so paths of them are listed as one: each node has
    its place below the head of its path, and heads have as many rows as their paths are long. The listing of the heads is
    an Euler tour: a head is entered, its children follow, it is left; each step knows the next one, and adding up the
    entries from a step to the end is one chain of pointers."""
    rows = written_table(tree, "tour")
    one_each = rows.groupBy(node).agg(F.count(F.lit(1)).alias("_n")).where(F.col(node).isNull() | (F.col("_n") > 1)).isEmpty()
    ordered = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    if levelled and one_each:
        up = rows.select(F.col(node).alias("_node"), F.when(F.col("level") > 1, F.col(parent)).alias("_up"), *ordered,
                         F.col("level").alias("_level"), F.col("root").alias("_root"))
    else:
        known = rows.select(F.col(node).alias("_known"))
        up = rows.join(known, F.col(parent) == F.col("_known"), "left").select(
            F.col(node).alias("_node"), F.col("_known").alias("_up"), *ordered)
    n = rows.count()
    listed = lambda heads: _listed_heads(heads, [f"_o{i}" for i in range(len(order))]).select(F.col("_node").alias("_at"), "_left")
    if one_each:
        heads, places = _paths(up, levelled)
        found = places.join(listed(heads), F.col("_of") == F.col("_at")).select(
            F.col("_node").alias("_at"), (F.col("_left") - F.col("_place") + 1).alias("_left"))
    else:  # every node is the head of its path
        found = listed(up.select("*", F.col("_up").alias("_above"), F.lit(1).cast("long").alias("_n")))
    return rows.join(found, F.col(node) == F.col("_at")).withColumn(name, F.lit(n) + 1 - F.col("_left")).drop("_at", "_left")


def _paths(up: DataFrame, levelled: bool) -> tuple[DataFrame, DataFrame]:
    """From (_node, _up, order columns, and _level and _root if `levelled`): the heads of paths of only children (the same
    columns, _up replaced by the head of its path as `_above`, and `_n`, the length of their path); and for each node its
    head (_of) and its `_place`, 1 for the head."""
    counted = F.count(F.lit(1)).alias("_n")
    up = up if levelled else written_table(up, "parents")
    forks = written_table(up.where("_up is not null").groupBy(F.col("_up").alias("_fork")).agg(counted).where("_n > 1").select("_fork"), "forks")
    split = up.join(forks, F.col("_up") == F.col("_fork"), "left")
    split = split.withColumn("_head", F.col("_up").isNull() | F.col("_fork").isNotNull()).drop("_fork")
    links = lambda some: some.select(F.col("_node").alias("id"), F.when(~F.col("_head"), F.col("_up")).alias("next"), F.lit(1).cast("long").alias("amount"))
    as_places = lambda found: found.select(F.col("id").alias("_node"), F.col("end").alias("_of"), F.col("total").alias("_place"))
    if levelled:
        # a tree without forks is one path, whose places are its levels
        split = written_table(split, "paths")
        forked = split.where("_head and _up is not null").select(F.col("_root").alias("_forked")).distinct()
        forked = written_table(forked, "forked")
        bent = split.join(forked, F.col("_root") == F.col("_forked"), "left_semi")
        places = split.join(forked, F.col("_root") == F.col("_forked"), "left_anti").select(
            "_node", F.col("_root").alias("_of"), F.col("_level").alias("_place"))
        if not forked.isEmpty():
            places = places.unionByName(as_places(chained(links(bent))[0]))
    else:
        split = written_table(split, "paths")
        places = as_places(chained(links(split))[0])
    places = written_table(places, "places")
    lengths = places.groupBy(F.col("_of").alias("_long")).agg(counted)
    above = places.select(F.col("_node").alias("_bottom"), F.col("_of").alias("_above"))
    heads = split.where("_head").join(lengths, F.col("_node") == F.col("_long"))
    top, lower = heads.where("_up is null"), heads.where("_up is not null")
    heads = top.withColumn("_above", F.col("_up")).unionByName(lower.join(above, F.col("_up") == F.col("_bottom")).drop("_bottom"))
    return heads, places


def _listed_heads(heads: DataFrame, order: list[str]) -> DataFrame:
    """(_node, _left): the rows listed from each head to the end of the listing, its own path included."""
    placed = written_table(running_total(heads.select("_node", "_above", "_n", *order), ["_above"], order, "_k").select(
        "_node", "_above", "_n", "_k"), "siblings")
    first = placed.where("_k = 1 and _above is not null").select(F.col("_above").alias("_of"), F.col("_node").alias("_child"))
    later = placed.select(F.col("_above").alias("_of"), (F.col("_k") - 1).alias("_after"), F.col("_node").alias("_sibling"))
    step = lambda at, entered: F.struct(F.col(at).alias("node"), F.lit(entered).alias("entered"))
    enter = placed.join(first, F.col("_node") == F.col("_of"), "left").select(
        step("_node", True).alias("id"), F.when(F.col("_child").isNull(), step("_node", False)).otherwise(step("_child", True)).alias("next"),
        F.col("_n").alias("amount"))
    leave = placed.join(later, F.col("_above").eqNullSafe(F.col("_of")) & (F.col("_k") == F.col("_after")), "left").select(
        step("_node", False).alias("id"), F.when(F.col("_sibling").isNotNull(), step("_sibling", True))
        .when(F.col("_above").isNotNull(), step("_above", False)).alias("next"), F.lit(0).cast("long").alias("amount"))
    found, _ = chained(enter.unionByName(leave))
    return found.where("id.entered").select(F.col("id.node").alias("_node"), F.col("total").alias("_left"))
