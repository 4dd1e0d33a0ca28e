"""Exact duplicates up to white space."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.text import remove_whitespace
from corpuslens.session import materialize

# Bytes of bitmaps that one scan gets by broadcast; a bit for every row of its files.
BROADCAST_BYTES = 64 * 1024 * 1024

# What a row of the table of bitmaps takes besides the bits.
_ROW_BYTES = 512


def text_key(text: Column) -> Column:
    """32-byte digest of the text without white space."""
    return F.unhex(F.sha2(remove_whitespace(text), 256))


def first_of_each_text(df: DataFrame, order_by: str, text: str = "text") -> DataFrame:
    """``order_by`` of the first row of every distinct text, and the number of its ``copies``.

    Only digest and order value are shuffled. A text that makes up a large part of the
    corpus is reduced to one row per map task before the shuffle.
    """
    keys = df.select(text_key(F.col(text)).alias("_key"), F.col(order_by))
    groups = keys.groupBy("_key").agg(
        F.min(order_by).alias(order_by), F.count(F.lit(1)).alias("copies")
    )
    return groups.drop("_key")


def drop_duplicate_texts(df: DataFrame, order_by: str, text: str = "text") -> DataFrame:
    """Keep the first row of every text, first by the unique number column ``order_by``.

    ``order_by`` must identify a row; a null in it is an error, whatever the size of the
    table, because which row is the first would be undefined. Texts are grouped by digest and
    only the order values to keep are joined back, on that unique column, so no task receives
    a hot group. The kept values are a stored table whose size the planner knows: it sends
    them to the texts where they are few. Otherwise the texts are shuffled once; a table
    bucketed by the order column is not.
    """
    if not df.filter(F.col(order_by).isNull()).isEmpty():
        raise ValueError(f"{order_by} must not be null")
    kept = materialize(first_of_each_text(df, order_by, text).select(order_by))
    return df.join(kept, order_by, "left_semi")


def first_positions(scan: DataFrame, text: str = "text", order_by: str | None = None) -> DataFrame:
    """``file`` and ``row`` of the first row of every distinct text of a parquet table.

    First by ``order_by``, else by path and place in the file; places also decide between equal
    order values. Only digests and places are shuffled, one row per text and map task.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    order = [F.col(order_by).alias("order")] if order_by else []
    found = scan.select(text_key(F.col(text)).alias("_key"), F.struct(*order, *place).alias("_place"))
    return found.groupBy("_key").agg(F.min("_place").alias("_place")).select("_place.file", "_place.row")


def position_bitmaps(positions: DataFrame) -> DataFrame:
    """Positions ``file``, ``row`` as bitmaps: ``file``, ``bucket`` and ``bits``, up to 4,096
    bytes for 32,768 rows, cut behind the last bit that is set."""
    bit = F.bitmap_bit_position("row")
    bitmaps = positions.groupBy("file", F.bitmap_bucket_number("row").alias("bucket")).agg(
        F.bitmap_construct_agg(bit).alias("bits"), F.max(bit).alias("last")
    )
    length = (F.shiftright("last", 3) + 1).cast("int")
    return bitmaps.select("file", "bucket", F.substring("bits", F.lit(1), length).alias("bits"))


def at_positions(scan: DataFrame, bitmaps: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of a parquet table whose place is set in ``bitmaps``, a stored table.

    Bitmaps are sent to the scan, which drops the other rows at once: no row of the table is
    shuffled or sorted. Where they are more than ``broadcast_bytes``, files are dealt into that
    many scans by a hash of their path, each with its own bitmaps; a condition on the path is
    settled while a scan is planned, so every file is still read once.
    """
    size = bitmaps.agg(F.sum(F.octet_length("bits") + F.lit(_ROW_BYTES))).first()[0] or 0
    scans = -(-size // broadcast_bytes) or 1
    row = F.col("_metadata.row_index")
    placed = scan.select(
        "*",
        F.col("_metadata.file_path").alias("_place_file"),
        F.bitmap_bucket_number(row).alias("_place_bucket"),
        F.bitmap_bit_position(row).alias("_place_bit"),
    )
    maps = bitmaps.select(
        F.col("file").alias("_place_file"), F.col("bucket").alias("_place_bucket"), F.col("bits").alias("_place_bits")
    )
    byte = F.substring("_place_bits", (F.shiftright("_place_bit", 3) + 1).cast("int"), F.lit(1))
    byte = F.coalesce(F.conv(F.hex(byte), 16, 10).cast("int"), F.lit(0))
    is_set = F.expr("shiftright(_place_byte, cast(_place_bit % 8 AS int)) & 1 = 1")
    out = None
    for number in range(scans):
        mine = F.pmod(F.xxhash64("_place_file"), F.lit(scans)) == number
        part, own = (placed.filter(mine), maps.filter(mine)) if scans > 1 else (placed, maps)
        part = part.join(F.broadcast(own), ["_place_file", "_place_bucket"])
        part = part.withColumn("_place_byte", byte).filter(is_set).select(*scan.columns)
        out = part if out is None else out.unionByName(part)
    return out


def drop_duplicate_rows_in_files(
    scan: DataFrame, text: str = "text", order_by: str | None = None, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Keep the first row of every text of a parquet table without shuffling any text.

    ``scan`` is a plain read of parquet files, perhaps with other columns selected. The table is
    scanned twice: for digests and places, and for the rows at the places that are kept. These
    are stored as bitmaps, a bit for every row. Texts that differ only in white space are equal,
    and so are nulls. See ``first_positions`` for the order and ``at_positions`` for the plan.
    """
    bitmaps = materialize(position_bitmaps(first_positions(scan, text, order_by)))
    return at_positions(scan, bitmaps, broadcast_bytes)
