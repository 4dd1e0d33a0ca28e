"""Languages, joins, aggregations, positions and samples."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators import languages, positions, reports
from corpuslens.session import materialize
from workload.registry import query
from workload.tables import SQL_FILES, SQL_META, SQL_TOTALS, corpus_files, table


def listing(spark, sf):
    """The file listing as a table, since it is read several times and comes from all texts."""
    return materialize(corpus_files(spark, sf))


def meta(spark, sf):
    return languages.with_language_totals(listing(spark, sf)).drop("length", "first_doc")


@query(
    "a1_file_table",
    f"SELECT pq_path, lang, lang_size_mb, lang_file_cnt FROM {SQL_META}",
)
def a1(spark, sf):
    return meta(spark, sf)


@query("a2_language_totals", f"SELECT lang, lang_size_mb, lang_file_cnt FROM {SQL_TOTALS}")
def a2(spark, sf):
    return languages.language_totals(corpus_files(spark, sf))


@query(
    "a3_first_file",
    f"SELECT lang, min_by(pq_path, first_doc) AS pq_path FROM {SQL_FILES} GROUP BY lang",
)
def a3(spark, sf):
    return languages.first_file(corpus_files(spark, sf), "first_doc")


@query(
    "j1_totals_on_files",
    f"""SELECT f.pq_path, f.length, t.lang_size_mb, t.lang_file_cnt
        FROM {SQL_FILES} f LEFT JOIN {SQL_TOTALS} t ON f.lang = t.lang""",
)
def j1(spark, sf):
    joined = languages.with_language_totals(listing(spark, sf))
    return joined.select("pq_path", "length", "lang_size_mb", "lang_file_cnt")


_SQL_TOP = f"(SELECT lang FROM {SQL_TOTALS} ORDER BY lang_size_mb DESC, lang LIMIT 2)"


@query(
    "j2_files_of_top_languages",
    f"SELECT pq_path, lang, lang_size_mb, lang_file_cnt FROM {SQL_META} WHERE lang IN {_SQL_TOP}",
)
def j2(spark, sf):
    return languages.select_languages(meta(spark, sf), top_k=2)


@query(
    "j2_rows_of_top_languages",
    f"SELECT doc_id, lang, n_chars FROM documents WHERE lang IN {_SQL_TOP}",
)
def j2_rows(spark, sf):
    chosen = languages.select_languages(meta(spark, sf), top_k=2)
    rows = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return languages.restrict_to_languages(rows, chosen)


@query(
    "j3_without_listed",
    """WITH sizes AS (SELECT source, sum(n_chars) AS n FROM documents GROUP BY source)
       SELECT doc_id, lang, source FROM documents
       WHERE source NOT IN (SELECT source FROM sizes WHERE n > (SELECT avg(n) FROM sizes))""",
)
def j3(spark, sf):
    """Documents of sources that are not larger than the mean source."""
    docs = table(spark, sf, "documents")
    sizes = docs.groupBy("source").agg(F.sum("n_chars").alias("n"))
    large = sizes.filter(F.col("n") > sizes.agg(F.avg("n")).scalar())
    rows = docs.select("doc_id", "lang", "source")
    return languages.without(rows, large, "source").select("doc_id", "lang", "source")


@query(
    "o1_top_languages",
    f"""SELECT lang, lang_size_mb AS weight FROM {SQL_TOTALS}
        ORDER BY lang_size_mb DESC, lang LIMIT 3""",
)
def o1(spark, sf):
    return languages.top_languages(meta(spark, sf), 3)


@query(
    "o1_top_languages_by_size_and_files",
    f"""SELECT lang, lang_size_mb * lang_file_cnt AS weight FROM {SQL_TOTALS}
        ORDER BY weight DESC, lang LIMIT 3""",
)
def o1_files(spark, sf):
    return languages.top_languages(meta(spark, sf), 3, rank_by="size_x_files")


@query(
    "o2_languages_by_size",
    f"SELECT lang, lang_size_mb FROM {SQL_TOTALS} ORDER BY lang_size_mb DESC, lang",
)
def o2(spark, sf):
    totals = languages.language_totals(corpus_files(spark, sf)).select("lang", "lang_size_mb")
    return totals.orderBy(F.desc("lang_size_mb"), "lang")


_META_COLUMNS = f"SELECT pq_path, lang, lang_size_mb, lang_file_cnt FROM {SQL_META}"


@query(
    "f10_size_threshold",
    f"{_META_COLUMNS} WHERE lang_size_mb > 0.3::DOUBLE",
)
def f10(spark, sf):
    return languages.select_languages(meta(spark, sf), mb_size_thresh=0.3)


@query("f11_file_count_threshold", f"{_META_COLUMNS} WHERE lang_file_cnt >= 100")
def f11(spark, sf):
    return languages.select_languages(meta(spark, sf), pq_file_cnt_thresh=100)


@query("f12_excluded_languages", f"{_META_COLUMNS} WHERE lang NOT IN ('fr', '.csv')")
def f12(spark, sf):
    return languages.select_languages(meta(spark, sf), bad_langs=("fr", ".csv"))


@query(
    "f13_selector_precedence",
    f"{_META_COLUMNS} WHERE lang IN {_SQL_TOP} AND lang <> 'en'",
)
def f13(spark, sf):
    # the size and count limits would drop everything, but top_k goes first
    return languages.select_languages(
        meta(spark, sf), top_k=2, mb_size_thresh=1e9, pq_file_cnt_thresh=10**9, bad_langs=("en",)
    )


# Positions and samples ---------------------------------------------------------------------

_SQL_INDEXED = """(SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index,
                     count(*) OVER () AS total FROM orders)"""


def orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "o4_exact_sample",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM (
         SELECT *, row_number() OVER (ORDER BY md5('7|' || o_orderkey)) AS rn,
           count(*) OVER () AS total FROM orders)
       WHERE rn <= round_even(total * 0.1::DOUBLE, 0)""",
)
def o4(spark, sf):
    return positions.sample_exact(orders(spark, sf), 0.1, "o_orderkey", seed=7)


@query("o4_approximate_sample")
def o4_approximate(spark, sf):
    return positions.sample_approximate(orders(spark, sf), 0.1, seed=7)


@query(
    "o4_approximate_sample_size",
    "SELECT count(*) AS n_rows, true AS near, 0::BIGINT AS n_foreign FROM orders",
)
def o4_approximate_size(spark, sf):
    """Size of an approximate sample within six standard deviations, and its rows all of the table."""
    rows = orders(spark, sf)
    sample = positions.sample_approximate(rows, 0.1, seed=7)
    foreign = sample.join(rows, rows.columns, "left_anti")
    parts = [frame.select(F.lit(name).alias("part")) for name, frame in
             (("row", rows), ("sampled", sample), ("foreign", foreign))]
    n_rows, sampled, n_foreign = (F.count_if(F.col("part") == name) for name in ("row", "sampled", "foreign"))
    counts = reduce(DataFrame.unionByName, parts).agg(
        n_rows.alias("n_rows"), sampled.alias("n"), n_foreign.alias("n_foreign")
    )
    near = F.abs(F.col("n") - 0.1 * F.col("n_rows")) <= 6 * F.sqrt(0.09 * F.col("n_rows"))
    return counts.select("n_rows", near.alias("near"), "n_foreign")


@query(
    "o5_segment",
    f"""SELECT row_index, o_orderkey, o_custkey, o_totalprice FROM {_SQL_INDEXED}
        WHERE row_index >= floor(total * 0.3::DOUBLE) AND row_index < floor(total * 0.3::DOUBLE) * 2""",
)
def o5(spark, sf):
    indexed = positions.with_row_index(orders(spark, sf), ["o_orderkey"])
    return positions.take_segment(indexed, 0.3, 2)


@query(
    "o5_last_segment_with_remainder",
    f"""SELECT row_index, o_orderkey, o_custkey, o_totalprice FROM {_SQL_INDEXED}
        WHERE row_index >= floor(total * 0.3::DOUBLE) * 2""",
)
def o5_remainder(spark, sf):
    indexed = positions.with_row_index(orders(spark, sf), ["o_orderkey"])
    return positions.take_segment(indexed, 0.3, 3, cover_remainder=True)


@query(
    "o5_segment_of_customers",
    """SELECT row_index, o_custkey FROM (
         SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS row_index,
           count(*) OVER () AS total FROM orders)
       WHERE row_index < floor(total * 0.5::DOUBLE)""",
)
def o5_customers(spark, sf):
    """The order value repeats, so equal values are spread over partitions."""
    customers = orders(spark, sf).select("o_custkey")
    return positions.take_segment(positions.with_row_index(customers, ["o_custkey"]), 0.5, 1)


@query(
    "o6_chunks",
    f"""SELECT o_orderkey, row_index, row_index // 72 AS chunk_id FROM {_SQL_INDEXED}""",
)
def o6(spark, sf):
    numbered = positions.with_file_row_index(table(spark, sf, "orders"))
    return positions.with_chunks(numbered, 72).select("o_orderkey", "row_index", "chunk_id")


_SQL_RATES = """(SELECT event_id // 100 AS chunk_id,
                   count(*) FILTER (event_type <> 'error')::DOUBLE / count(*) * 100 AS success_rate
                 FROM events GROUP BY event_id // 100)"""


def rates(spark, sf):
    chunk = F.floor(F.col("event_id") / 100).cast("bigint").alias("chunk_id")
    events = table(spark, sf, "events").select(chunk, "event_type")
    return reports.chunk_success(events, F.col("event_type") != "error")


@query(
    "a5_chunk_success",
    f"SELECT chunk_id, round(success_rate, 6) AS success_rate FROM {_SQL_RATES}",
)
def a5(spark, sf):
    return rates(spark, sf).withColumn("success_rate", F.round("success_rate", 6))


@query(
    "w1_running_mean",
    f"""SELECT chunk_id, round(success_rate, 6) AS success_rate,
          round(avg(success_rate) OVER (ORDER BY chunk_id), 6) AS running_rate
        FROM {_SQL_RATES}""",
)
def w1(spark, sf):
    return reports.running_mean(rates(spark, sf)).select(
        "chunk_id",
        F.round("success_rate", 6).alias("success_rate"),
        F.round("running_rate", 6).alias("running_rate"),
    )
