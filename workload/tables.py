"""The test tables in the shape of a corpus, for Spark and for SQL.

``documents`` stands in for the corpus: ``text`` is the content, ``source`` the repository
and ``lang`` the language. The documents of one language and source among a hundred neighbours
stand in for one parquet file.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions.text import with_text_stats
from corpuslens.operators.rules import slim
from corpuslens.sources.readers import spread

# File name endings picked by document number.
ENDINGS = ["py", "js", "min.js", "csv", "PNG", "png", "ts", "gitattributes", "c", "tar", "md"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, for work that is bound by text processing."""
    return spread(table(spark, sf, "documents"))


def full_rows(texts: DataFrame, text: str, repo: str, lang: str) -> DataFrame:
    """Full corpus columns derived from raw text; the key columns stay."""
    return with_text_stats(texts, text).withColumns(
        {
            "content": F.col(text),
            "max_stars_repo_name": F.col(repo),
            "ext": F.lit("txt"),
            "lang": F.col(lang),
        }
    )


def slim_documents(spark: SparkSession, sf: str) -> DataFrame:
    full = full_rows(documents(spark, sf), "text", "source", "lang")
    return slim(full, also=[F.col("doc_id"), F.col("lang")])


def slim_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(table(spark, sf, "pages")).withColumn("kind", F.lit("html"))
    full = full_rows(pages, "html", "url", "kind")
    return slim(full, also=[F.col("page_id")])


def corpus_files(spark: SparkSession, sf: str) -> DataFrame:
    """Listing of the files the documents would be stored in."""
    part = F.floor(F.col("doc_id") / 100).alias("part")
    files = table(spark, sf, "documents").groupBy("lang", "source", part).agg(
        F.sum(F.octet_length("text")).alias("length"), F.min("doc_id").alias("first_doc")
    )
    name = F.concat_ws("-", "source", F.col("part"))
    path = F.concat(F.lit("corpus/"), "lang", F.lit("/"), name, F.lit(".parquet"))
    return files.select(path.alias("pq_path"), "lang", "length", "first_doc")


def file_names(spark: SparkSession, sf: str) -> DataFrame:
    """A repository-relative path for every document."""
    endings = F.array(*[F.lit(e) for e in ENDINGS])
    ending = F.element_at(endings, (F.col("doc_id") % len(ENDINGS) + 1).cast("int"))
    base = F.concat("source", F.lit("_"), "doc_id", F.lit("."), ending)
    # some without a dot, some hidden, some licences, some in an installed package
    base = (
        F.when(F.col("doc_id") % 13 == 0, F.lit("log"))
        .when(F.col("doc_id") % 17 == 0, F.concat(F.lit("."), base))
        .when(F.col("doc_id") % 19 == 0, F.concat(F.lit("LICENSE."), base))
        .otherwise(base)
    )
    folder = F.when(F.col("doc_id") % 5 == 0, F.lit("node_modules")).otherwise(F.col("lang"))
    return table(spark, sf, "documents").select(
        "doc_id", base.alias("base_name"), F.concat_ws("/", folder, base).alias("file_name")
    )


# SQL counterparts ---------------------------------------------------------------------

SQL_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
SQL_WHITESPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def sql_stats(source: str, text: str) -> str:
    """Subquery with the text statistics of every row of ``source``."""
    return rf"""(
      SELECT *,
        octet_length(encode({text}))::BIGINT AS size,
        list_max(lens)::BIGINT AS max_line_length,
        CASE WHEN n_lines = 0 THEN 0.0::DOUBLE
             ELSE list_sum(lens)::DOUBLE / n_lines::DOUBLE END AS avg_line_length,
        CASE WHEN length({text}) = 0 THEN 0.0::DOUBLE
             ELSE length(regexp_replace({text}, '[^\p{{L}}\p{{N}}]', '', 'g'))::DOUBLE
                  / length({text})::DOUBLE END AS alphanum_fraction
      FROM (
        SELECT *, len(lens) - CASE WHEN lens[-1] = 0 THEN 1 ELSE 0 END AS n_lines
        FROM (
          SELECT *, list_transform(string_split_regex({text}, '{SQL_LINE_BREAK}'),
                                   lambda piece: length(piece)) AS lens
          FROM {source})))"""


def sql_slim(source: str, text: str, key: str, repo: str, lang: str) -> str:
    return f"""(
      SELECT {key}, {repo} AS repo_name, 'txt' AS file_ext, {text} AS content,
        size::INTEGER AS file_size, max_line_length::INTEGER AS max_ll,
        avg_line_length::FLOAT AS ave_ll, alphanum_fraction::FLOAT AS alphanum_frac,
        {lang} AS repo_lang
      FROM {sql_stats(source, text)})"""


SQL_SLIM = sql_slim("documents", "text", "doc_id", "source", "lang")
SQL_SLIM_PAGES = sql_slim("pages", "html", "page_id", "url", "'html'")

SQL_FILES = """(
      SELECT 'corpus/' || lang || '/' || source || '-' || (doc_id // 100) || '.parquet' AS pq_path,
        lang, sum(octet_length(encode(text)))::BIGINT AS length, min(doc_id) AS first_doc
      FROM documents GROUP BY lang, source, doc_id // 100)"""

SQL_TOTALS = f"""(
      SELECT lang, sum(length)::DOUBLE / 1048576 AS lang_size_mb, count(*) AS lang_file_cnt
      FROM {SQL_FILES} GROUP BY lang)"""

SQL_META = f"""(
      SELECT f.pq_path, f.lang, t.lang_size_mb, t.lang_file_cnt
      FROM {SQL_FILES} f JOIN {SQL_TOTALS} t ON f.lang = t.lang)"""

_endings = ", ".join(f"'{e}'" for e in ENDINGS)
SQL_FILE_NAMES = f"""(
      SELECT doc_id, base_name,
        CASE WHEN doc_id % 5 = 0 THEN 'node_modules' ELSE lang END || '/' || base_name AS file_name
      FROM (
        SELECT doc_id, lang,
          CASE WHEN doc_id % 13 = 0 THEN 'log'
               WHEN doc_id % 17 = 0 THEN '.' || b
               WHEN doc_id % 19 = 0 THEN 'LICENSE.' || b ELSE b END AS base_name
        FROM (SELECT doc_id, lang, source || '_' || doc_id || '.'
                || ([{_endings}])[doc_id % {len(ENDINGS)} + 1] AS b FROM documents)))"""
