"""Sinks written to the checkpoint folder and read back through the sources."""

from pyspark.sql import functions as F

from corpuslens import schemas
from corpuslens.operators import positions, rules
from corpuslens.plans.curate import LanguageChoice, curate, curate_with_funnel
from corpuslens.plans.extract import archive_rows
from corpuslens.session import scratch_path
from corpuslens.sources import readers, writers
from workload.corpus_queries import meta
from workload.registry import query
from workload.rule_queries import TIERS, sql_funnel, sql_labelled, sql_reason
from workload.tables import (
    SQL_META,
    SQL_SLIM,
    documents,
    full_rows,
    table,
)


def corpus_tree(spark, sf):
    """Documents as full corpus rows under one directory per language; the path to it."""
    rows = full_rows(documents(spark, sf), "text", "source", "lang")
    # the repository name carries the document number through the slim projection
    name = F.concat_ws("/", "source", "doc_id")
    rows = rows.withColumn("max_stars_repo_name", name).withColumn("folder", F.col("lang"))
    known = set(rows.columns)
    columns = [
        F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.FULL.fields
    ]
    path = scratch_path(spark, "corpus")
    rows.select(*columns, "folder").write.partitionBy("folder").parquet(path)
    return path


_DOC_ID = "CAST(split(repo_name, '/')[1] AS bigint)"


@query(
    "s1_s3_corpus_tree_scan",
    f"""SELECT doc_id, 'folder=' || repo_lang AS lang, file_size, max_ll,
          md5(content) AS content_md5 FROM {SQL_SLIM}""",
)
def corpus_tree_scan(spark, sf):
    rows = readers.scan_corpus_tree(spark, corpus_tree(spark, sf))
    return rows.select(
        F.expr(_DOC_ID).alias("doc_id"), "lang", "file_size", "max_ll",
        F.md5("content").alias("content_md5"),
    )


@query(
    "k1_k2_curated_table",
    f"""SELECT doc_id, verdict, lang, reason FROM (
          SELECT doc_id, verdict, repo_lang AS lang, reason
          FROM {sql_labelled(TIERS['moderate'])})""",
)
def curated_table(spark, sf):
    rows = documents(spark, sf).select("doc_id", "text", "lang")
    labelled = rules.cascade_text(rows, TIERS["moderate"], "off", "text", "lang")
    path = scratch_path(spark, "curated")
    writers.write_curated(labelled, path)
    return spark.read.parquet(path).select("doc_id", "verdict", "lang", "reason")


@query(
    "k1_curated_corpus",
    f"""SELECT doc_id, file_size, 'folder=' || repo_lang AS lang
        FROM (SELECT *, {sql_reason(TIERS['permissive'])} AS reason FROM {SQL_SLIM})
        WHERE reason IS NULL AND repo_lang <> 'fr'""",
)
def curated_corpus(spark, sf):
    """The whole curation from tree to table, kept rows of all languages but one."""
    root, out = corpus_tree(spark, sf), scratch_path(spark, "curation")
    curate(spark, root, out, "permissive", LanguageChoice(bad_langs=("folder=fr",)))
    kept = writers.read_kept(writers.read_curated(spark, f"{out}/rows"))
    return kept.select(F.expr(_DOC_ID).alias("doc_id"), "file_size", "lang")


@query(
    "f9_kept_full_moderate",
    f"SELECT doc_id, file_size FROM {sql_labelled(TIERS['moderate'])} WHERE verdict = 'kept'",
)
def kept_full(spark, sf):
    """Kept rows of a stored full corpus, whose bounds reach the scan."""
    stored = readers.scan_full(spark, corpus_tree(spark, sf))
    kept = rules.kept_full(stored, TIERS["moderate"])
    return kept.select(F.expr(_DOC_ID).alias("doc_id"), "file_size")


@query(
    "k3_file_table",
    f"""SELECT pq_path, lang, lang_size_mb, lang_file_cnt,
          'out/rows/verdict=kept/lang=' || lang AS filtered_pq_path FROM {SQL_META}""",
)
def file_table(spark, sf):
    files, path = meta(spark, sf), scratch_path(spark, "files")
    target = writers.kept_directory("out/rows", F.col("lang"))
    files = files.withColumn("filtered_pq_path", target)
    writers.write_file_table(files, path)
    back = spark.read.schema(files.schema).option("header", True).csv(path)
    return back.select("pq_path", "lang", "lang_size_mb", "lang_file_cnt", "filtered_pq_path")


@query(
    "k4_s6_archive",
    """SELECT md5(text) AS text_md5, length(text) AS n, source AS repo_name,
         'doc_' || doc_id AS file_name, 'text/plain' AS mime_type
       FROM documents WHERE length(text) BETWEEN 16 AND 1048576""",
)
def archive(spark, sf):
    files = documents(spark, sf).select(
        F.col("source").alias("repo_name"),
        F.concat(F.lit("doc_"), "doc_id").alias("file_name"),
        F.encode("text", "UTF-8").alias("content"),
    )
    path = scratch_path(spark, "archive")
    writers.write_archive(archive_rows(files), path)
    return readers.read_archive(spark, path).select(
        F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n"), "meta.*"
    )


@query("k5_s5_url_manifest", "SELECT url FROM pages")
def url_manifest(spark, sf):
    path = scratch_path(spark, "urls")
    writers.write_url_manifest(table(spark, sf, "pages"), path)
    return readers.read_url_manifest(spark, path)


@query("s4_repo_list", "SELECT source || '/' || doc_id AS repo_name FROM documents")
def repo_list(spark, sf):
    path = scratch_path(spark, "repos")
    docs = table(spark, sf, "documents")
    named = docs.select("lang", F.concat_ws("/", "source", "doc_id").alias("repo_name"), "n_chars")
    named.write.option("header", True).csv(path)
    return readers.read_repo_list(spark, path)


@query(
    "o5_segment_of_list",
    """SELECT repo_name FROM (
         SELECT source || '/' || doc_id AS repo_name, count(*) OVER () AS total,
           row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS row_index FROM documents)
       WHERE row_index >= floor(total * 0.3::DOUBLE) AND row_index < floor(total * 0.3::DOUBLE) * 2""",
)
def segment_of_list(spark, sf):
    """The second segment of a list in the order of its lines, which is not that of the names."""
    docs = table(spark, sf, "documents").select(
        F.concat_ws("/", "source", "doc_id").alias("repo_name"), F.md5(F.col("doc_id").cast("string")).alias("rank"), "doc_id"
    )
    path = scratch_path(spark, "repos")
    # sorted by range, files are named in that order
    docs.orderBy("rank", "doc_id").write.option("header", True).csv(path)
    repos = readers.read_repo_list(spark, path)
    return positions.select_listed_repos(repos, 0.3, 2)


@query(
    "s9_listing",
    """SELECT 'source=' || source AS folder, sum(octet_length(encode(text)) + 1)::BIGINT AS length
       FROM documents GROUP BY source""",
)
def listing(spark, sf):
    """Sizes of text files, one for each source; a byte for every line end."""
    path = scratch_path(spark, "texts")
    texts = table(spark, sf, "documents").select("text", "source").repartition("source")
    texts.write.partitionBy("source").text(path)
    files = readers.list_files(spark, path)
    return files.select(F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("folder"), "length")


@query(
    "s8_json_documents",
    """SELECT conv_id, count(*) AS n_turns, sum(length(text))::BIGINT AS n_chars, max(turn) AS last_turn
       FROM conversations GROUP BY conv_id""",
)
def json_documents(spark, sf):
    """Conversations as JSON documents, a file for each thousandth, read without a schema."""
    path = scratch_path(spark, "json")
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    talks = table(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("turns"))
    part = (F.col("conv_id") / 1000).cast("int")
    books = talks.groupBy(part.alias("part")).agg(F.collect_list(F.struct("conv_id", "turns")).alias("talks"))
    json = F.to_json(F.struct("part", "talks")).alias("value")
    books.select(json, "part").repartition("part").write.partitionBy("part").text(path)
    books = readers.typed_documents(readers.read_json_documents(spark, path))
    talks = books.select(F.explode("talks").alias("talk")).select("talk.conv_id", F.explode("talk.turns").alias("t"))
    return talks.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sum(F.length("t.text")).alias("n_chars"), F.max("t.turn").alias("last_turn")
    )


@query("a4_funnel_of_curation", sql_funnel(TIERS["moderate"]))
def funnel_of_curation(spark, sf):
    """The funnel that a curation counts while it writes."""
    root, out = corpus_tree(spark, sf), scratch_path(spark, "curation")
    return curate_with_funnel(spark, root, out, "moderate", python_gate="off")[1]


@query(
    "k4_archive_at_intervals",
    """WITH sized AS (SELECT (max(doc_id) // 100 + 4) // 4 AS every FROM documents)
       SELECT doc_id // 100 // every AS commit, min(doc_id // 100) AS first_chunk,
         max(doc_id // 100) AS last_chunk, count(*) AS n_rows, sum(length(text))::BIGINT AS n_chars
       FROM documents, sized GROUP BY ALL""",
)
def archive_at_intervals(spark, sf):
    """An archive of four ranges of chunks, stopped after two of them and then completed."""
    docs = table(spark, sf, "documents").withColumn("chunk", F.floor(F.col("doc_id") / 100))
    n_chunks = docs.agg(F.max("chunk")).first()[0] + 1

    def rows_of(first, last):
        name = F.concat(F.lit("doc_"), "doc_id").alias("file_name")
        meta = F.struct(F.col("source").alias("repo_name"), name, F.lit("text/plain").alias("mime_type"))
        return docs.filter(F.col("chunk").between(first, last)).select("text", meta.alias("meta"))

    path, every = scratch_path(spark, "archive"), (n_chunks + 3) // 4
    writers.write_archive_at_intervals(spark, rows_of, n_chunks, path, every, most=2)
    commits = writers.write_archive_at_intervals(spark, rows_of, n_chunks, path, every)
    doc = F.substring_index("meta.file_name", "_", -1).cast("bigint")
    rows = readers.read_archive(spark, path).select(F.floor(doc / 100 / every).alias("commit"), "text")
    chars = rows.groupBy("commit").agg(F.sum(F.length("text")).alias("n_chars"))
    return commits.join(chars, "commit")
