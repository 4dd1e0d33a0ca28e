"""Language totals over a listing of corpus files, and the choice of languages.

A listing has one row per parquet file with ``pq_path``, ``lang`` and ``length`` in bytes.
It is small next to the corpus but may still have millions of rows, so totals are grouped
with partial aggregation and joined back without any hint: the planner compares their size
with its broadcast threshold.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.text import byte_size
from corpuslens.session import materialize

# Fixed value: excluded unless the caller says otherwise.
DEFAULT_BAD_LANGS = (".csv",)


def language_totals(files: DataFrame, unit: str = "MB") -> DataFrame:
    """Total size and number of files of each language."""
    return files.groupBy("lang").agg(
        byte_size(F.sum("length"), unit).cast("double").alias("lang_size_mb"),
        F.count(F.lit(1)).alias("lang_file_cnt"),
    )


def first_file(files: DataFrame, order_by: str = "pq_path") -> DataFrame:
    """The first file of each language by ``order_by``."""
    return files.groupBy("lang").agg(F.min_by("pq_path", order_by).alias("pq_path"))


def with_language_totals(files: DataFrame) -> DataFrame:
    """Attach the totals of its language to every file.

    The listing is read twice, so one that is costly to compute should be materialized.
    """
    return files.join(language_totals(files), "lang", "left")


def top_languages(meta: DataFrame, k: int, rank_by: str = "size") -> DataFrame:
    """The ``k`` largest languages, largest first, ties by name.

    ``rank_by="size_x_files"`` sums the language size over the rows of the file table, so a
    language counts as often as it has files.
    """
    if rank_by not in ("size", "size_x_files"):
        raise ValueError("rank_by must be 'size' or 'size_x_files'")
    weigh = F.max if rank_by == "size" else F.sum
    ranked = meta.groupBy("lang").agg(weigh("lang_size_mb").alias("weight"))
    return ranked.orderBy(F.desc("weight"), "lang").limit(k)


def is_excluded(lang: Column, bad_langs: tuple[str, ...]) -> Column:
    return F.coalesce(lang.isin(list(bad_langs)), F.lit(False))


def select_languages(
    meta: DataFrame,
    top_k: int | None = None,
    mb_size_thresh: float | None = None,
    pq_file_cnt_thresh: int | None = None,
    bad_langs: tuple[str, ...] = DEFAULT_BAD_LANGS,
    rank_by: str = "size",
) -> DataFrame:
    """Files of the chosen languages.

    ``top_k`` goes before the size threshold and that before the file count; zero means
    not set. Excluded languages are removed last, whatever was chosen.
    """
    if top_k:
        chosen = top_languages(meta, top_k, rank_by).select("lang")
        meta = meta.join(chosen, "lang", "left_semi")
    elif mb_size_thresh:
        meta = meta.filter(F.col("lang_size_mb") > float(mb_size_thresh))
    elif pq_file_cnt_thresh:
        meta = meta.filter(F.col("lang_file_cnt") >= pq_file_cnt_thresh)
    if bad_langs:
        meta = meta.filter(~is_excluded(F.col("lang"), tuple(bad_langs)))
    return meta


def without(df: DataFrame, blocked: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is not listed in ``blocked``, for lists too long for literals.

    The join is planned by size; skewed values stay whole because the blocked side is
    made distinct first and the other side may be split by adaptive execution.
    """
    return df.join(blocked.select(column).distinct(), column, "left_anti")


def restrict_to_languages(corpus: DataFrame, selected: DataFrame, lang: str = "lang") -> DataFrame:
    """Corpus rows whose language occurs in ``selected``.

    Corpus rows carry text and one language may hold a third of them, so they are not shuffled
    by language: the names, which are stored first, are sent to the scan. There are no more of
    them than directories, whose paths the driver holds for any scan of the corpus. Where
    ``lang`` is a partition column, the same names choose the directories to be read, whatever
    their number; the comparison, which every name passes, makes the planner consider that.
    """
    names = materialize(selected.select(F.col("lang").alias(lang)).distinct())
    names = names.filter(F.length(lang) >= 0)
    return corpus.join(F.broadcast(names), lang, "left_semi")
