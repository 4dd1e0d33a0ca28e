"""Text extraction from landed repository checkouts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions.decoding import decode_first_fit, decode_text, is_text, mime_type
from corpuslens.functions.paths import has_valid_name
from corpuslens.functions.text import keep_text
from corpuslens.operators.reports import chunk_success, repo_success, running_mean
from corpuslens.sources.readers import (
    list_landed,
    list_repositories,
    on_disk,
    read_contents,
    scan_landed,
)

# A character takes four bytes at most, and a byte order mark as many more.
_BYTES_PER_CHAR = 4
_MARK = 4


def archive_rows(
    files: DataFrame,
    fallback: str | None = "ISO-8859-1",
    max_mb: float = 1,
    min_chars: int = 16,
    charsets: Sequence[str] | None = None,
) -> DataFrame:
    """Files with bytes to rows of text and metadata; what is not text is dropped.

    ``charsets``, an ordered list, takes the place of ``fallback``; the first that fits is named
    in the column ``charset``, and content that fits none is dropped.
    """
    body = F.col("content")
    meta = F.struct("repo_name", "file_name", mime_type(body).alias("mime_type")).alias("meta")
    texts = files.filter(is_text(body))
    if charsets is None:
        decoded = texts.select(decode_text(body, fallback).alias("text"), meta)
    else:
        decoded = texts.select(decode_first_fit(body, charsets).alias("_decoded"), meta)
        decoded = decoded.select("_decoded.text", "meta", "_decoded.charset")
    return decoded.filter(keep_text(F.col("text"), max_mb, min_chars))


def extract(
    repos: DataFrame,
    root: str,
    additional_extensions: list[str] | None = None,
    match_on: str = "name",
    fallback: str | None = "ISO-8859-1",
    max_mb: float = 1,
    min_chars: int = 16,
    charsets: Sequence[str] | None = None,
) -> DataFrame:
    """Text of every acceptable file of the listed repositories under ``root``.

    Names and lengths are checked on the listing, before any byte is read. The length
    bounds follow from the character bounds, so they drop nothing that would be kept.
    """
    wanted = _wanted(additional_extensions, match_on, max_mb, min_chars)
    listed = list_repositories(repos, root).filter(wanted)
    return archive_rows(read_contents(listed), fallback, max_mb, min_chars, charsets)


def extract_landed(
    spark: SparkSession,
    root: str,
    additional_extensions: list[str] | None = None,
    match_on: str = "name",
    fallback: str | None = "ISO-8859-1",
    max_mb: float = 1,
    min_chars: int = 16,
    charsets: Sequence[str] | None = None,
) -> DataFrame:
    """Text of every acceptable file below ``root``, without a list of repositories.

    As ``extract``, for whole trees without names that begin with an underscore and without
    hidden folders, which Spark's file sources do not see. On a mounted disk tasks list the tree
    and read what is wanted of it; other stores are read in one scan of Spark's own file source.
    """
    wanted = _wanted(additional_extensions, match_on, max_mb, min_chars)
    if on_disk(spark, root):
        files = read_contents(list_landed(spark, root).filter(wanted), missing="error")
    else:
        files = scan_landed(spark, root).filter(wanted)
    return archive_rows(files, fallback, max_mb, min_chars, charsets)


def _wanted(additional: list[str] | None, match_on: str, max_mb: float, min_chars: int) -> Column:
    """Conditions on name and length that a file must meet to be opened."""
    most = int(max_mb * 1024**2) * _BYTES_PER_CHAR + _MARK
    valid = has_valid_name(F.col("file_name"), additional, match_on)
    return valid & F.col("length").between(min_chars, most)


def outcomes(repos: DataFrame, extracted: DataFrame, chunk_size: int) -> DataFrame:
    """Chunk, number of extracted files and failure flag of every listed repository.

    ``repos`` carries ``row_index`` and may carry ``failed``. Files are counted per
    repository before the join, so a repository with very many files is one row in it.
    """
    counts = extracted.groupBy(F.col("meta.repo_name").alias("repo_name")).agg(
        F.count(F.lit(1)).alias("n_files")
    )
    failed = F.col("failed") if "failed" in repos.columns else F.lit(False)
    return repos.join(counts, "repo_name", "left").select(
        "repo_name",
        F.floor(F.col("row_index") / chunk_size).cast("bigint").alias("chunk_id"),
        F.coalesce("n_files", F.lit(0)).alias("n_files"),
        failed.alias("failed"),
    )


def success_report(results: DataFrame, count_empty_as_success: bool = True) -> DataFrame:
    """Success rate of every chunk and the mean over the chunks so far."""
    done = repo_success(results, count_empty_as_success)
    return running_mean(chunk_success(results, done))
