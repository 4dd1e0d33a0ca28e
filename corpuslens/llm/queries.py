"""One query per operator over its whole table, with its SQL twin where there is one."""

from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm import (
    best_fit,
    chat_format,
    cutting_stock,
    decontamination,
    host_quality,
    jaccard_join,
    language_id,
    line_dedup,
    periodic_runs,
    prefix_trie,
    substring_dedup,
    suffix_dedup,
    tokens,
    toxicity,
)
from corpuslens.session import materialize

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """Remainder of the CRC of a number as text."""
    return F.crc32(F.col(key).cast("string")) % folds


# 2 ---------------------------------------------------------------------------------------

OP2_SQL = r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, unnest(w[i:i + 4]) AS word, generate_subscripts(w[i:i + 4], 1) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)),
texts AS (
  SELECT doc_id, i, string_agg(word, ' ' ORDER BY k) AS s FROM windows GROUP BY doc_id, i),
repeated AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM texts) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY doc_id),
figures AS (
  SELECT words.doc_id, source, len(w) AS n_words,
    length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
     - len(list_distinct(list_filter(string_split(t, chr(10)),
           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN covered USING (doc_id)),
base AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM figures),
hosts AS (
  SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (base_failed)::DOUBLE AS bad
  FROM base GROUP BY source),
prior AS (SELECT avg(bad / n) AS m, var_pop(bad / n) AS v FROM hosts),
fitted AS (
  SELECT m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 100.0 END, 1.0), 1e6) AS s
  FROM prior),
condemned AS (
  SELECT source, (bad + m * s) / (n + s) > 0.5 AS gone FROM hosts, fitted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT gone AS kept
FROM base JOIN condemned ON base.source IS NOT DISTINCT FROM condemned.source"""


@query("op2_host_quality", OP2_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return host_quality.host_quality(table(spark, sf, "documents"))


# 3 ---------------------------------------------------------------------------------------


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    """Writes the packed id matrix and returns its segments as read back from it."""
    docs = table(spark, sf, "documents")
    return best_fit.segments(materialize(best_fit.pack_best_fit(docs, tokens.default_path())))


# 4 ---------------------------------------------------------------------------------------

OP4_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, w, least(13, len(w)) AS m FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM items)),
places AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM words, (SELECT DISTINCT m FROM items) WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, places.m, item_id FROM places JOIN windows USING (m, s)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM hits GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""


@query("op4_decontamination", OP4_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


# 5 ---------------------------------------------------------------------------------------


@query("op5_language_id")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    return language_id.identify_language(
        table(spark, sf, "documents"),
        learn=F.col("doc_id").isNotNull() & (fold("doc_id", 3) != 1),
        keep=[held_out.alias("held_out")],
    )


# 6 ---------------------------------------------------------------------------------------

TRICKY = "\\### Assistant: </turn> ok"

OP6_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
levels AS (
  SELECT conv_id, bool_or(contains(text, '\-') OR contains(text, '\\')
    OR regexp_matches(text, '(^|[\n\\])### |</turn>')) AS escaped FROM rows GROUP BY conv_id),
written AS (
  SELECT rows.*, CASE WHEN escaped THEN replace(replace(replace(text, '\', '\\'),
      '###', '#\-##'), '</turn>', '<\-/turn>') ELSE text END AS shown
  FROM rows JOIN levels USING (conv_id))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(4 + length(role) + 2 + length(shown) + 8)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id"""


@query("op6_chat_format", OP6_SQL)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    chats = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    formatted = chat_format.format_chats(chats.unionByName(own)).select(
        "conv_id", "formatted", "loss_spans", chat_format.parse(F.col("formatted")).alias("_turns")
    )
    # the text under the mask, cut out of the formatted text by its spans
    loss = F.transform(
        "loss_spans",
        lambda s: chat_format.unescape(
            F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])
        ),
    )
    turns = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return formatted.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(F.array_join(loss, "")).cast("bigint").alias("loss_chars"),
        F.sha2(F.array_join(loss, ""), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


# 9 ---------------------------------------------------------------------------------------


@query("op9_cutting_stock")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return cutting_stock.pack_cutting_stock(table(spark, sf, "documents"), tokens.default_path())


# 1, 7, 8 ---------------------------------------------------------------------------------


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    cut = suffix_dedup.remove_repeated_bytes(table(spark, sf, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_jaccard_join")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf, "documents"))


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    cut = substring_dedup.remove_repeated_words(table(spark, sf, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# 10 --------------------------------------------------------------------------------------


@query("op10_toxicity")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return toxicity.score_toxicity(
        table(spark, sf, "documents"),
        table(spark, sf, "labels"),
        learn=F.col("doc_id").isNotNull() & (fold("doc_id", 5) != 0),
        keep=[F.col("doc_id"), held_out.alias("held_out")],
    )


# 11 --------------------------------------------------------------------------------------


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """From which word on a tenth of the documents repeat, and with which period."""
    h = crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf, "documents"), planted=planted, digest=True)
    # longest first, then by start and period
    best = F.array_min(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    found = found.withColumn("_best", F.when(F.size("runs") > 0, best))
    length = -F.col("_best.col1")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("_best.start").alias("start"),
        length.alias("length"),
        F.col("_best.period").alias("period"),
        F.floor(1000 * length / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )


# 12 --------------------------------------------------------------------------------------

# crc32 of a decimal number: a byte at a time, eight shifts each
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP12_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(text, '') AS text, substring(sha256(
    strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS d,
    list(strlen(text)::BIGINT ORDER BY turn NULLS FIRST, digest) AS w FROM said GROUP BY conv_id),
heads AS (SELECT *, (CRC % 9)::BIGINT AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.d[1:c.h], []), c.d[c.h + 1:]) AS d,
    list_concat(coalesce(b.w[1:c.h], []), c.w[c.h + 1:]) AS w
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
places AS (
  SELECT conv_id, k, array_to_string(d[1:k], '') AS node, array_to_string(d[1:k - 1], '') AS above,
    CASE WHEN k > 0 THEN w[k] ELSE 0 END AS bytes, k = len(d) AS ends
  FROM (SELECT *, unnest(range(0, len(d) + 1)) AS k FROM rebuilt)),
nodes AS (
  SELECT node, k AS depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(bytes) AS saved, any_value(conv_id) AS someone,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM places GROUP BY node, k),
children AS (SELECT above AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above),
below AS (
  SELECT p.node, sum(n.saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM nodes n JOIN places p ON p.conv_id = n.someone AND p.k <= n.depth
  LEFT JOIN children c ON c.node = n.node GROUP BY p.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
  b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN children c ON c.node = n.node
  LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.above""".replace("CRC", CRC32.format("conv_id"))


@query("op12_prefix_trie", OP12_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.shared_prefixes(table(spark, sf, "conversations"))


# 13 --------------------------------------------------------------------------------------

OP13_SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
lines AS (
  SELECT r, doc_id, unnest(string_split(t, chr(10))) AS line,
    generate_subscripts(string_split(t, chr(10)), 1) AS i FROM rows),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (
  SELECT k FROM (SELECT DISTINCT k, doc_id FROM keyed WHERE k <> '') GROUP BY k HAVING count(*) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.k) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (common.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON keyed.k = common.k GROUP BY r, doc_id"""


@query("op13_line_dedup", OP13_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    cut = line_dedup.remove_common_lines(table(spark, sf, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
