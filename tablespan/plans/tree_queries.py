"""The region / nation / customer tree."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tablespan.operators.hierarchy import depth_first, indented, levels, walk
from tablespan.operators.ordinals import running_total
from tablespan.scratch import written_table
from tablespan.plans.registry import Tables, query

NODES = """
      SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS parent, r_name AS label FROM region
      UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'R' || CAST(n_regionkey AS VARCHAR), n_name FROM nation
      UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), 'N' || CAST(c_nationkey AS VARCHAR), c_name FROM customer"""


def _nodes(t: Tables):
    def rows(df, prefix, key, parent, label):
        up = F.concat(F.lit(parent[0]), F.col(parent[1]).cast("string")) if parent else F.lit(None).cast("string")
        return df.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"),
                         up.alias("parent"), F.col(label).alias("label"))

    return (rows(t.region, "R", "r_regionkey", None, "r_name")
            .unionByName(rows(t.nation, "N", "n_nationkey", ("R", "n_regionkey"), "n_name"))
            .unionByName(rows(t.customer, "C", "c_custkey", ("N", "c_nationkey"), "c_name")))


@query("tree_depth", f"""
    WITH RECURSIVE nodes AS ({NODES}),
    tree AS (
      SELECT id, label, 1 AS level, id AS path, id[1] || lpad(id[2:], 19, '0') AS place FROM nodes WHERE parent IS NULL
      UNION ALL
      SELECT n.id, n.label, t.level + 1, t.path || '/' || n.id, t.place || '/' || n.id[1] || lpad(n.id[2:], 19, '0')
      FROM nodes n JOIN tree t ON n.parent = t.id)
    SELECT id, level, path, '-' || repeat('--', level - 1) || ' ' || label AS line,
      row_number() OVER (ORDER BY place) AS listed_as FROM tree""")
def _(t: Tables):
    listed = running_total(walk(_nodes(t), "id", "parent"), [], ["sort_path"], "listed_as")
    return listed.select("id", "level", F.concat_ws("/", "path").alias("path"), indented(F.col("label")).alias("line"), "listed_as")


@query("tree_descendants", f"""
    WITH RECURSIVE nodes AS ({NODES}),
    tree AS (
      SELECT id, 1 AS level FROM nodes WHERE id = 'R2'
      UNION ALL
      SELECT n.id, t.level + 1 FROM nodes n JOIN tree t ON n.parent = t.id WHERE n.label NOT LIKE '%7')
    SELECT id, level FROM tree WHERE level > 1""")
def _(t: Tables):
    # the condition prunes children, with everything below them, but not the root
    return (walk(_nodes(t), "id", "parent", F.col("id") == "R2", ~F.col("label").endswith("7"))
            .where("level > 1").select("id", "level"))


@query("thread_levels", """
    WITH placed AS (
      SELECT event_id, row_number() OVER w AS level, first_value(event_id) OVER w AS root FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING))
    SELECT event_id, level, root, row_number() OVER (ORDER BY root, level) AS listed_as FROM placed""")
def _(t: Tables):
    """Every event answers the one before it of the same user: a tree as deep as a user has events."""
    before = F.lag("event_id").over(Window.partitionBy("user_id").orderBy("event_id"))
    threads = written_table(t.events.select("event_id", before.alias("answers")), "threads")
    found, _ = levels(threads, "event_id", "answers")
    return depth_first(found, "event_id", "answers", ["event_id"], levelled=True).select("event_id", "level", "root", "listed_as")
