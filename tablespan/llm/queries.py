"""The registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.llm import chat, impacts, jaccard, langid, merkle, mixing, packing, repair, repeats, rules, secret_scan, url_lists, weak_labels
from tablespan.sources.tables import read_table

JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(job):
        JOBS[name] = job
        if sql is not None:
            SQL[name] = sql
        return job

    return register


# The control strings of another template, in a conversation that is formatted along with the table.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query("op3_chat_formatting", sql="""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    e AS (
        SELECT *, regexp_replace(text, '([<\\[])(\\\\*)(\\||/?s>|/?INST\\]|<SYS>>|</SYS>>)', '\\1\\\\\\2\\3', 'g') AS body,
               regexp_replace(role, '([<\\[])(\\\\*)(\\||/?s>|/?INST\\]|<SYS>>|</SYS>>)', '\\1\\\\\\2\\3', 'g') AS name
        FROM t),
    s AS (
        SELECT *, 23 + length(name) + length(body) AS chars,
               sum(23 + length(name) + length(body)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                   ROWS UNBOUNDED PRECEDING) AS upto
        FROM e)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
               AS loss_sha256,
           sum(chars)::BIGINT AS formatted_chars,
           count(*) FILTER (role = 'assistant') AS n_examples,
           coalesce(sum(upto) FILTER (role = 'assistant'), 0)::BIGINT AS expanded_chars
    FROM s GROUP BY conv_id
""")
def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], table.schema)
    return chat.digests(chat.formatted_turns(table.unionByName(extra)))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.tokenised_pieces(read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed(pieces)


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.judged(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op9_ngram_jaccard_join")
def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.written_components(read_table(spark, folder, "documents")).drop("hash", "root")


@query("op10_suffix_array_dedup")
def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.without_repeats(read_table(spark, folder, "documents"))
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


MIX = mixing.Targets(
    source={"src0": 0.10}, lang={"en": 0.58, "de": 0.15, "fr": 0.15, "es": 0.10},
    topic={"long": 0.58, "medium": 0.29, "licensed": 0.02})


def _mixing_sql() -> str:
    def category(column: str, named: dict) -> str:
        return f"CASE WHEN {column} IN ({', '.join(map(repr, named))}) THEN {column} ELSE '(other)' END"

    d = mixing.DIMENSIONS
    out = [f"""WITH w AS MATERIALIZED (
        SELECT doc_id, source, lang, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
        FROM documents),
    t AS MATERIALIZED (
        SELECT doc_id, n_tokens, {category("source", MIX.source)} AS source, {category("lang", MIX.lang)} AS lang,
            {category("(CASE WHEN contains(text, 'License') THEN 'licensed' WHEN n_tokens >= 600 THEN 'long' "
                      "WHEN n_tokens >= 200 THEN 'medium' ELSE 'short' END)", MIX.topic)} AS topic FROM w),
    c0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS n, 1.0::DOUBLE AS f FROM t
        GROUP BY ALL HAVING sum(n_tokens) > 0),
    want AS MATERIALIZED (SELECT * FROM (VALUES """ + ", ".join(
        f"('{x}', '{k}', {share!r}::DOUBLE)" for x in d for k, share in MIX.of(x).items()) + """) v(d, k, s)),
    there AS MATERIALIZED (SELECT d, k, s / sum(s) OVER (PARTITION BY d) AS s FROM want WHERE """ + " OR ".join(
        f"(d = '{x}' AND k IN (SELECT {x} FROM c0))" for x in d) + ")"]
    last = "c0"
    for i in range(mixing.SWEEPS):
        for j, x in enumerate(d):
            out.append(f"c{i}_{j} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.n, "
                       f"c.f * w.s / sum(c.n * c.f) OVER (PARTITION BY c.{x}) AS f "
                       f"FROM {last} c JOIN there w ON w.d = '{x}' AND w.k = c.{x})")
            last = f"c{i}_{j}"
    return ",\n".join(out) + f"""
    SELECT t.doc_id, t.source, t.lang, t.topic, t.n_tokens, round(f / (SELECT max(f) FROM {last}), 9) AS probability
    FROM t JOIN {last} c USING (source, lang, topic)
    WHERE ('0x' || substr(md5('mix-' || coalesce(t.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0
        < f / (SELECT max(f) FROM {last})"""


@query("op5_source_mixing", sql=_mixing_sql())
def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.weighted(read_table(spark, folder, "documents"), MIX).filter("drawn")
    return found.select("row.doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 9).alias("probability"))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    documents = read_table(spark, folder, "documents").withColumn("held_out", held_out)
    model = langid.fit(documents.filter(~F.col("held_out")))
    return langid.predict(documents, model, ["doc_id", "held_out"])


@query("op6_exact_top_k", sql="""
    WITH v AS (
        SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)])::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
    SELECT query_id, rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    WHERE rank <= 10
""")
def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = impacts.integer_vectors(read_table(spark, folder, "embeddings"))
    return impacts.top_k(vectors, vectors.filter("vec_id % 100 = 0"), 10)


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return weak_labels.classified(read_table(spark, folder, "documents"))


def _drawn(value, salt: str, n: int):
    """A reproducible number from 0 to n - 1."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), value.cast("string"))), 1, 8), 16, 10).cast("long") % n


_HOST_SQL = "regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\\.+$', '')"


# The tables hold neither fetch days nor lists. Both derive from the pages: a day of two years by page_id, and for some
# of the hosts and of their domains an addition, for half of these a later removal, for a quarter a second addition.
@query("op2_url_lists", sql=f"""
    WITH c AS (
        SELECT page_id, nullif({_HOST_SQL}, '') AS host,
               DATE '2023-01-01' + (('0x' || substr(md5('fetch' || page_id::VARCHAR), 1, 8))::BIGINT % 730)::INTEGER AS fetched_on
        FROM pages),
    k AS (SELECT DISTINCT page_id, host, fetched_on, list_aggregate((string_split(host, '.'))[i:], 'string_agg', '.') AS key
        FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM c WHERE host IS NOT NULL)),
    h AS (
        SELECT key, ('0x' || substr(md5('list' || key), 1, 8))::BIGINT % 16 AS r,
               DATE '2023-01-01' + (('0x' || substr(md5('day' || key), 1, 8))::BIGINT % 500)::INTEGER AS day
        FROM (SELECT DISTINCT key FROM k WHERE contains(key, '.'))),
    v AS (
        SELECT key, day AS since, CASE WHEN r < 2 THEN day + 100 END AS until FROM h WHERE r < 4
        UNION ALL SELECT key, day + 160, NULL FROM h WHERE r < 1),
    m AS (SELECT k.page_id, k.key, v.since, row_number() OVER (PARTITION BY page_id ORDER BY length(k.key) DESC) AS n
        FROM k JOIN v ON k.key = v.key AND v.since <= fetched_on AND (v.until IS NULL OR fetched_on < v.until))
    SELECT c.page_id, c.host, c.fetched_on, m.key IS NOT NULL AS listed, m.key AS matched, m.since
    FROM c LEFT JOIN m ON c.page_id = m.page_id AND m.n = 1
""")
def op2_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    start = F.lit("2023-01-01").cast("date")
    captures = pages.withColumn("day", F.date_add(start, _drawn(F.col("page_id"), "fetch", 730).cast("int")))
    keys = pages.select(F.explode(url_lists.domains_of(url_lists.host_of(F.col("url")))).alias("key")).distinct().filter(F.col("key").contains("."))
    first = F.date_add(start, _drawn(F.col("key"), "day", 500).cast("int"))
    keys = keys.select("key", first.alias("first"), _drawn(F.col("key"), "list", 16).alias("r"))
    events = F.array(*[F.struct(F.date_add("first", n).alias("day"), F.lit(added).alias("added"), F.lit(below).alias("below"))
                       for n, added, below in ((0, True, 4), (100, False, 2), (160, True, 1))])
    entries = keys.select("key", "r", F.inline(events)).filter("r < below").select("key", "day", "added")
    found = url_lists.listed_at_fetch(captures, entries, "url", "day")
    return found.select("row.page_id", "host", "fetched_on", "listed", "matched", "since")


def _crc32(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a text of ASCII characters: a character is mixed in, then eight steps follow it."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(str_split({text}, ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END))"""


@query("op11_merkle_manifest", sql=f"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, coalesce('1' || source, '0') AS tree,
               {{head}} || coalesce(strlen(text) || ':' || text, '-') AS intact,
               {{head}} || coalesce(strlen(now) || ':' || now, '-') AS present
        FROM (SELECT *, CASE WHEN {_crc32('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS now FROM documents)),
    leaves AS (
        SELECT doc_id, tree, sha256(intact) AS node, sha256(present) AS present,
               row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, sha256(intact)) - 1 AS pos
        FROM docs),
    nodes AS (
        SELECT tree, 0 AS level, pos, node, count(*) OVER (PARTITION BY tree) AS n FROM leaves
        UNION ALL
        SELECT tree, any_value(level) + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3
        FROM nodes WHERE n > 1 GROUP BY tree, pos // 3),
    subroots AS (SELECT tree, level AS height, node, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE n = 1),
    outer_nodes AS (
        SELECT 0 AS level, pos, node, count(*) OVER () AS n FROM subroots
        UNION ALL
        SELECT any_value(level) + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3
        FROM outer_nodes WHERE n > 1 GROUP BY pos // 3),
    steps AS (
        SELECT l.tree, l.pos, n.level, l.pos // (3 ** n.level)::BIGINT AS at FROM leaves l JOIN nodes n ON l.tree = n.tree AND n.pos = 0 AND n.n > 1
        UNION ALL
        SELECT l.tree, l.pos, s.height + o.level, s.pos // (3 ** o.level)::BIGINT
        FROM leaves l JOIN subroots s ON l.tree = s.tree JOIN outer_nodes o ON o.pos = 0 AND o.n > 1),
    siblings AS (
        SELECT s.tree, s.pos, s.level, coalesce(string_agg(x.node, '' ORDER BY x.pos) FILTER (x.pos < s.at), '') AS before,
               coalesce(string_agg(x.node, '' ORDER BY x.pos) FILTER (x.pos > s.at), '') AS after
        FROM steps s JOIN subroots r ON s.tree = r.tree
        JOIN (SELECT tree, level, pos, node FROM nodes UNION ALL SELECT NULL, level, pos, node FROM outer_nodes) x
          ON x.pos // 3 = s.at // 3 AND CASE WHEN s.level < r.height THEN x.tree = s.tree AND x.level = s.level
                                             ELSE x.tree IS NULL AND x.level = s.level - r.height END
        GROUP BY s.tree, s.pos, s.level),
    folds AS (
        SELECT tree, pos, 0 AS level, present AS node FROM leaves
        UNION ALL
        SELECT f.tree, f.pos, f.level + 1, sha256(s.before || f.node || s.after)
        FROM folds f JOIN siblings s ON f.tree = s.tree AND f.pos = s.pos AND f.level = s.level)
    SELECT l.doc_id, l.node AS leaf, r.node AS subroot, top.node AS root,
           sha256(coalesce(p.proof, '')) AS proof_sha256, f.node AS folded_root, f.node = top.node AS verified
    FROM leaves l JOIN subroots r ON l.tree = r.tree JOIN outer_nodes top ON top.n = 1
    LEFT JOIN (SELECT tree, pos, string_agg(before || after, '' ORDER BY level) AS proof FROM siblings GROUP BY tree, pos) p
      ON l.tree = p.tree AND l.pos = p.pos
    JOIN (SELECT tree, pos, arg_max(node, level) AS node FROM folds GROUP BY tree, pos) f ON l.tree = f.tree AND l.pos = f.pos
""".replace("{head}", " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars"))))
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    # where the CRC-32 of the doc_id is even, the text has lost its line breaks since the manifest was made
    lost = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(lost, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    return merkle.manifest(read_table(spark, folder, "documents"), present={"text": text})


@query("op12_secret_scan")
def op12_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.found_secrets(read_table(spark, folder, "documents"), ["doc_id"])
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(secret_scan.BASE_KINDS))
    return found.select("row.doc_id", *[of_kind(kind).alias(f"n_{kind}") for kind in secret_scan.BASE_KINDS],
                        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"))


@query("op13_conversation_repair", sql=f"""
    WITH RECURSIVE source AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fate
        FROM conversations),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
               CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM source),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged),
    last_seen AS (
        SELECT *, role[1] AS initial, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS ending,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
               lag(role[1]) OVER (PARTITION BY conv_id ORDER BY pos) || role[1] AS pair
        FROM numbered),
    turns AS (
        SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
        FROM last_seen),
    inserts(state, more, reached) AS (
        VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (3, 0, 3), (3, 1, 2)),
    moves(state, edit, initial, reached, cost) AS (
        VALUES (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0),
               (0, 'R', '', 2, 3), (1, 'R', '', 2, 3), (2, 'R', '', 3, 3), (3, 'R', '', 2, 3),
               (0, 'D', '', 0, 4), (1, 'D', '', 1, 4), (2, 'D', '', 2, 4), (3, 'D', '', 3, 4)),
    prefixes AS (
        SELECT DISTINCT conv_id, 0::BIGINT AS pos, 0 AS state, {{'cost': 0::BIGINT, 'audit': ''}} AS best FROM turns
        UNION ALL
        SELECT p.conv_id, t.pos, m.reached, min({{
            'cost': p.best.cost + 3 * i.more + m.cost + CASE WHEN t.fault = 'truncated' AND m.edit <> 'D' THEN 3 ELSE 0 END,
            'audit': p.best.audit || repeat('I', i.more) || m.edit}})
        FROM prefixes p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.pos = p.pos + 1
        JOIN inserts i ON i.state = p.state
        JOIN moves m ON m.state = i.reached AND (m.edit = 'D' OR t.fault IN ('none', 'truncated') AND (m.edit = 'R' OR m.initial = t.initial))
        GROUP BY p.conv_id, t.pos, m.reached),
    reports AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
               count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
        FROM turns GROUP BY conv_id),
    chosen AS (
        SELECT r.conv_id, min({{'cost': p.best.cost + 3 * e.more, 'audit': p.best.audit || repeat('I', e.more)}}) AS best
        FROM reports r JOIN prefixes p ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND p.pos = r.n
        JOIN (VALUES (0, 0), (1, 2), (2, 1), (3, 0)) e(state, more) ON e.state = p.state
        GROUP BY r.conv_id),
    letters AS (SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS i FROM chosen),
    edits AS (
        SELECT conv_id, audit[i] AS edit, length(replace(audit, 'D', '')) AS n, length(replace(audit[:i], 'I', '')) AS pos,
               length(replace(audit[:i], 'D', '')) AS place
        FROM letters),
    digests AS (
        SELECT e.conv_id, sha256(coalesce(string_agg(
                   CASE WHEN e.edit = 'K' THEN t.role WHEN (e.place - e.n % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                   CASE WHEN e.edit = 'I' THEN '' ELSE t.text END, chr(10) ORDER BY e.place) FILTER (e.edit <> 'D'), '')) AS digest
        FROM edits e LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.pos = e.pos
        GROUP BY e.conv_id)
    SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(c.best.cost, 0)::BIGINT AS cost,
           coalesce(c.best.audit, '') AS audit, coalesce(d.digest, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN reports r ON o.conv_id IS NOT DISTINCT FROM r.conv_id
    LEFT JOIN chosen c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN digests d ON o.conv_id IS NOT DISTINCT FROM d.conv_id
""")
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "conversations")
    return repair.repaired(repair.damaged(table), originals=table)
