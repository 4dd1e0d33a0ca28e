"""Where results go. Every writer is one job; the commit protocol makes it all or nothing."""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.schemas import SLIM

# Printable characters that Spark escapes in directory names, besides the percent.
_ESCAPED = "\"#'*/:=?\\{[]^"

# Rows of one output file; keeps a large language from ending in one huge file.
MAX_RECORDS_PER_FILE = 500_000


def write_curated(
    labelled: DataFrame,
    path: str,
    mode: str = "errorifexists",
    rebalance: bool = False,
    keep_origin: bool = True,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Write kept rows and rejects in one pass as ``verdict=.../lang=...`` directories.

    Rows keep their original order inside each output file where ``src_path`` and
    ``src_row`` are present; ``keep_origin`` says whether these two are written. Without ``rebalance`` nothing is shuffled: a corpus stored by
    language gives each task one or two directories to write. With it, rows are regrouped
    into files of the advisory size, and a language too large for one task is split.
    """
    keys = ["verdict", "lang"]
    if rebalance:
        labelled = labelled.hint("rebalance", *keys)
    origin = [c for c in ("src_path", "src_row") if c in labelled.columns]
    ordered = labelled.sortWithinPartitions(*keys, *origin)
    if not keep_origin:
        ordered = ordered.drop(*origin)
    writer = ordered.write.mode(mode).partitionBy(*keys)
    writer.option("maxRecordsPerFile", max_records_per_file).parquet(path)


def kept_directory(path: str, lang: Column) -> Column:
    """Directory below ``path`` that holds the kept rows of a language.

    Spark writes some characters of a partition value as percent escapes.
    """
    value = F.replace(lang, F.lit("%"), F.lit("%25"))
    for char in _ESCAPED:
        value = F.replace(value, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return F.concat(F.lit(f"{path.rstrip('/')}/verdict=kept/lang="), value)


def read_curated(
    spark: SparkSession, path: str, schema: T.StructType = SLIM, keep_origin: bool = True
) -> DataFrame:
    """What ``write_curated`` wrote, with declared types: a language called ``02`` stays text,
    and output without any row is an empty table."""
    names = ["src_path string", "src_row bigint"] if keep_origin else []
    names += ["reason string", "verdict string", "lang string"]
    declared = T.StructType(schema.fields + T.StructType.fromDDL(", ".join(names)).fields)
    return spark.read.schema(declared).parquet(path)


def read_kept(curated: DataFrame) -> DataFrame:
    return curated.filter(F.col("verdict") == "kept")


def write_file_table(files: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Table of the curated input files as CSV with a header."""
    files.write.mode(mode).option("header", True).csv(path)


def write_archive(
    extracted: DataFrame, path: str, mode: str = "errorifexists", compression: str = "gzip"
) -> None:
    """JSON lines with ``text`` and ``meta``; every task writes its own part."""
    extracted.select("text", "meta").write.mode(mode).option("compression", compression).json(path)


# Fixed value: chunks to a commit.
COMMIT_EVERY = 10_000

COMMITS = "commit bigint, first_chunk bigint, last_chunk bigint, n_rows bigint"


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """The ranges of chunks that an archive holds, with the number of rows of each."""
    folder = f"{path.rstrip('/')}/_commits"
    try:
        return spark.read.schema(COMMITS).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def write_archive_at_intervals(
    spark: SparkSession,
    rows_of: Callable[[int, int], DataFrame],
    n_chunks: int,
    path: str,
    commit_every: int = COMMIT_EVERY,
    compression: str = "gzip",
    most: int | None = None,
) -> DataFrame:
    """Write an archive range by range; a run that was stopped goes on where it ended.

    ``rows_of(first, last)`` gives ``text`` and ``meta`` of the chunks ``first`` to ``last``, both
    included; it is called for the ranges that are missing only, so no other chunk is extracted
    again. Every range is a partition ``commit=...`` of the archive, written by one job that puts
    it in place as a whole, and then a mark below ``_commits``, which readers do not see. A range
    without its mark is written again and replaces itself. The last range is short where the
    chunks do not fill it; if the list has grown since, it is written again too. ``most`` limits
    the ranges of this run. Returns the marks of all ranges, see ``read_commits``.
    """
    if commit_every < 1:
        raise ValueError("commit_every must be positive")
    out = path.rstrip("/")
    done = {r["commit"]: r for r in read_commits(spark, out).collect()}
    for commit, mark in done.items():
        if mark["first_chunk"] != commit * commit_every or mark["last_chunk"] >= (commit + 1) * commit_every:
            raise ValueError(f"{path} was written with other intervals")
    written = 0
    for commit in range(-(-n_chunks // commit_every)):
        first = commit * commit_every
        last = min(first + commit_every, n_chunks) - 1
        if commit in done and done[commit]["last_chunk"] >= last:
            continue
        if most is not None and written == most:
            break
        counted = Observation()
        rows = rows_of(first, last).select("text", "meta").observe(counted, F.count(F.lit(1)).alias("n"))
        writer = rows.withColumn("commit", F.lit(commit)).write.mode("overwrite").partitionBy("commit")
        writer = writer.option("partitionOverwriteMode", "dynamic").option("compression", compression)
        writer.json(out)
        mark = spark.createDataFrame([(commit, first, last, counted.get["n"])], COMMITS).coalesce(1)
        writer = mark.write.mode("overwrite").partitionBy("commit")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{out}/_commits")
        written += 1
    return read_commits(spark, out).select("commit", "first_chunk", "last_chunk", "n_rows")


def write_url_manifest(urls: DataFrame, path: str, mode: str = "errorifexists") -> None:
    urls.select("url").write.mode(mode).option("header", True).csv(path)


def in_original_order(df: DataFrame) -> DataFrame:
    """Sort by input file and position in it, over the whole table."""
    return df.orderBy("src_path", "src_row")
