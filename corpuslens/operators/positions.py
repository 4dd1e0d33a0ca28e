"""Operators that depend on the position of a row in the whole table.

None of them uses an unpartitioned window over data that grows with the input: positions
come from counts per partition or per bucket, of which there is a fixed number.
"""

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.session import materialize

# Hexadecimal digits by which each histogram of a sample extends the last, and those of a digest.
_BUCKET_DIGITS = 4
_DIGEST_DIGITS = 32


def _running_total(counts: DataFrame, order_by: str) -> DataFrame:
    """``counts(order_by, n)`` with rows before each entry and rows in all.

    The caller guarantees that ``counts`` has a bounded number of rows.
    """
    before = Window.orderBy(order_by).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(order_by).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return counts.select(
        order_by,
        "n",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"),
        F.sum("n").over(everything).alias("_total"),
    )


def with_row_index(
    df: DataFrame, order_by: list[str], name: str = "row_index", partitions: int | None = None
) -> DataFrame:
    """Number the rows from 0 in the order of ``order_by``; adds ``_total`` as well.

    Rows are range-partitioned and sorted once. Columns outside ``order_by`` and the input
    position break ties, so a value that fills a third of the table is still spread over
    many partitions. The sorted table is written to the checkpoint folder together with
    partition number and offset: the second step cannot see another partitioning than the
    first, even if an executor was lost. The input is read twice, for the range boundaries
    and for the rows: select the columns needed before the call, and materialize the input
    where it is costly to compute.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in df.columns if c not in order_by]
    ties = [F.xxhash64(*others)] if others else []
    keyed = df.withColumn("_tie", F.struct(*ties, F.monotonically_increasing_id()))
    ordered = keyed.repartitionByRange(parts, *order_by, "_tie").sortWithinPartitions(
        *order_by, "_tie"
    )
    # partition number in the upper bits, offset within the partition in the lower 33
    placed = materialize(
        ordered.drop("_tie").withColumn("_place", F.monotonically_increasing_id())
    )
    placed = placed.withColumns(
        {
            "_part": F.shiftright("_place", 33),
            "_offset": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    starts = _running_total(counts, "_part").drop("n")  # one row per partition
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_before") + F.col("_offset"))
        .drop("_part", "_place", "_offset", "_before")
    )


def _starts(counts: DataFrame, group: str, member: str) -> DataFrame:
    """``counts(group, member, n)`` with the rows before each entry, and rows in all.

    Groups are ordered by ``group`` and entries within one by ``member``. Sums run per group in
    parallel; one row per group is left for the window without partitions.
    """
    inside = Window.partitionBy(group).orderBy(member)
    entries = counts.select(
        group,
        member,
        F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_inside"),
    )
    groups = _running_total(counts.groupBy(group).agg(F.sum("n").alias("n")), group).drop("n")
    return entries.join(groups, group).select(
        group, member, (F.col("_before") + F.col("_inside")).alias("_before"), "_total"
    )


def with_file_row_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Number the rows of a parquet table from 0 in file order; adds ``_total`` as well.

    Files are ordered by folder and then by name. Needs neither sort nor shuffle of the rows: the
    position inside a file comes with the scan, and the rows before each file follow from counts
    per file, summed per folder and then over folders. A filtered table keeps the numbers its
    rows have in the whole files; ``_total`` counts those.
    """
    path = F.col("_metadata.file_path")
    files = df.inputFiles()
    if not files:
        return df.withColumns({name: F.lit(0).cast("bigint"), "_total": F.lit(0).cast("bigint")})
    escaped = [re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(f)) for f in files]
    whole = df.sparkSession.read.parquet(*escaped)
    counts = whole.groupBy(path.alias("_file")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("_folder", F.regexp_extract("_file", "^(.*)/[^/]*$", 1))
    starts = _starts(counts, "_folder", "_file").drop("_folder")
    placed = df.select("*", path.alias("_file"), F.col("_metadata.row_index").alias("_offset"))
    return (
        placed.join(starts, "_file")
        .withColumn(name, F.col("_before") + F.col("_offset"))
        .drop("_file", "_offset", "_before")
    )


def with_line_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Number the rows of a CSV, JSON-lines or text table from 0 in the order of its lines; adds
    ``_total`` as well.

    Files follow each other by path. Formats of lines have no row positions, but a scan knows the
    file and the first byte of the split that a row lies in, and reads the lines of a split one
    after another. The table, to which filters and projections may have been applied but nothing
    that moves rows, is stored with those two and a running number of the task; counts per split
    then give the rows before each split. Nothing is sorted.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_line"),
    )
    placed = materialize(placed)
    counts = placed.groupBy("_file", "_split").agg(
        F.count(F.lit(1)).alias("n"), F.min("_line").alias("_first")
    )
    starts = _starts(counts, "_file", "_split").join(counts.drop("n"), ["_file", "_split"])
    return (
        placed.join(starts, ["_file", "_split"])
        .withColumn(name, F.col("_before") + F.col("_line") - F.col("_first"))
        .drop("_file", "_split", "_line", "_first", "_before")
    )


def segment_bounds(total: Column, frac: float, number: int, cover_remainder: bool) -> Column:
    size = F.floor(total * F.lit(float(frac)))
    start = size * (number - 1)
    segments = round(1 / frac)
    if cover_remainder and number > segments:
        return F.lit(False)  # the last segment holds all that was left over
    last = cover_remainder and number == segments
    return (F.col("row_index") >= start) & (F.col("row_index") < (total if last else size * number))


def take_segment(indexed: DataFrame, frac: float, number: int, cover_remainder: bool = False) -> DataFrame:
    """Segment ``number`` (from 1) of ``frac`` of the rows of an indexed table.

    Rows that are left over after the last whole segment belong to no segment, unless
    ``cover_remainder`` adds them to it. A fraction of 1 or more is the whole table.
    """
    if frac < 1.0:
        bounds = segment_bounds(F.col("_total"), frac, number, cover_remainder)
        indexed = indexed.filter(bounds)
    return indexed.drop("_total")


def with_chunks(indexed: DataFrame, size: int) -> DataFrame:
    """Number consecutive blocks of ``size`` rows; the last may be short."""
    if size < 1:
        raise ValueError("size must be positive")
    chunk = F.floor(F.col("row_index") / size).cast("bigint")
    return indexed.withColumn("chunk_id", chunk).drop("_total")


def sample_exact(df: DataFrame, frac: float, key: str, seed: int = 0) -> DataFrame:
    """Exactly ``round(frac * rows)`` rows, chosen by a digest of ``key`` and ``seed``.

    The rows with the smallest digests are taken, up to a border that is found digit by digit: a
    histogram over the first digits of the digest, 65,536 entries at most, tells which bucket
    the border lies in, and the next one looks at that bucket alone. These passes read ``key``
    only. The sample is then a filter over one scan, so the table is neither sorted nor shuffled.
    Rows that share the digest of the border, which are rows of one key, are told apart by their
    position; they alone are ranked, by many tasks.
    """
    if not 0 <= frac <= 1:
        raise ValueError("frac must be from 0 to 1")
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    keyed = df.withColumn("_digest", digest)
    prefix, missing = "", None
    while len(prefix) < _DIGEST_DIGITS:
        width = len(prefix) + _BUCKET_DIGITS
        inside = keyed.filter(F.col("_digest").startswith(prefix))
        counts = inside.groupBy(F.substring("_digest", 1, width).alias("_bucket"))
        totals = _running_total(counts.agg(F.count(F.lit(1)).alias("n")), "_bucket")
        if missing is None:
            wanted = F.bround(F.col("_total") * F.lit(float(frac)), 0).cast("bigint")
        else:
            wanted = F.lit(missing)
        border = (
            totals.withColumn("_missing", wanted - F.col("_before"))
            .filter((F.col("_missing") > 0) & (F.col("_missing") <= F.col("n")))
            .select("_bucket", "_missing", "n")
            .first()
        )
        if border is None:
            return df.limit(0)
        prefix, missing, held = border
        if missing == held:
            return keyed.filter(F.substring("_digest", 1, width) <= prefix).drop("_digest")
    whole = keyed.filter(F.col("_digest") < prefix)
    part = with_row_index(keyed.filter(F.col("_digest") == prefix), ["_digest"], "_rank")
    part = part.filter(F.col("_rank") < missing).drop("_rank", "_total")
    return whole.unionByName(part).drop("_digest")


def sample_approximate(df: DataFrame, frac: float, seed: int = 0) -> DataFrame:
    """About ``frac`` of the rows, without counting them."""
    return df.sample(fraction=frac, seed=seed)


def select_repos(
    repos: DataFrame, frac: float = 1.0, segment: int | None = 1, key: str = "repo_name", seed: int = 0
) -> DataFrame:
    """Part of a repository table: a segment by the order of ``key``, or a sample without one.

    A table has no order of its own; for a list in a file see ``select_listed_repos``.
    """
    if frac >= 1.0:
        return repos
    if segment is None:
        return sample_exact(repos, frac, key, seed)
    indexed = with_row_index(repos, [key])
    return take_segment(indexed, frac, segment).drop("row_index")


def select_listed_repos(
    repos: DataFrame, frac: float = 1.0, segment: int | None = 1, key: str = "repo_name", seed: int = 0
) -> DataFrame:
    """Part of a repository list as read from its file: a segment in the order of its lines, or a
    sample without one."""
    if frac >= 1.0 or segment is None:
        return select_repos(repos, frac, segment, key, seed)
    return take_segment(with_line_index(repos), frac, segment).drop("row_index")
