"""Benchmark decontamination as a prefix-filtered set join. Native expressions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.session import materialize

# Lower-cased words: all but [\x00-\x2F\x3A-\x60\x7B-\x7F]. Java takes several times as long
# to match the same class written as a negation.
WORD = r"[a-z0-9\x{80}-\x{10FFFF}]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words of a window, and of the shingles that windows are made of.
WINDOW, SHINGLE = 13, 4

# Shingles of the benchmark up to this many are broadcast, 8 bytes each; beyond it the planner
# shuffles both sides.
MAX_BROADCAST_SHINGLES = 1_000_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(
        F.translate(F.coalesce(text, F.lit("")), UPPER, SMALL), F.lit(WORD), F.lit(0)
    )


def shingles(words: Column, size: int) -> Column:
    """Hash of every ``size`` consecutive words, in order."""
    places = F.sequence(F.lit(0), F.size(words) - size)
    hashes = F.transform(
        places, lambda i: F.xxhash64(F.lit(size), *[F.get(words, i + k) for k in range(size)])
    )
    return F.when(F.size(words) >= size, hashes)


def within_bound(small: DataFrame) -> DataFrame:
    """Broadcast ``small`` if its counted rows are few enough."""
    return F.broadcast(small) if small.count() <= MAX_BROADCAST_SHINGLES else small


def item_windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """Every distinct window: its words, length, shingle size and shingles, and its items."""
    items = benchmark.select(F.col(item).cast("string").alias("_item"), words_of(F.col(text)).alias("_w"))
    items = items.filter(F.size("_w") > 0)
    length = F.least(F.lit(WINDOW), F.size("_w"))
    starts = F.sequence(F.lit(0), F.size("_w") - length)
    windows = items.select("_item", "_w", length.alias("_len"), F.explode(starts).alias("_at"))
    windows = windows.select("_item", "_len", F.slice("_w", F.col("_at") + 1, F.col("_len")).alias("_words"))
    windows = windows.groupBy("_words", "_len").agg(F.array_sort(F.collect_set("_item")).alias("_items"))
    size = F.least(F.lit(SHINGLE), F.col("_len"))
    sets = F.coalesce(*[F.when(size == s, shingles(F.col("_words"), s)) for s in range(1, SHINGLE + 1)])
    return windows.withColumns({"_size": size, "_set": sets})


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Words of every document that lie in an occurrence of a benchmark window.

    A window is 13 consecutive words of an item, or a whole shorter item. As a set of
    four-word shingles it must be contained in the document entirely, so its necessary
    prefix under any order is its first shingle; the order is by rarity in the corpus, which
    one pass counts. Only documents with that rarest shingle become candidates; the place of
    the shingle fixes where the window would start, which must lie inside the text; then all
    its words are compared. The join on shingles keeps single places of documents, never
    pairs of them, and its output is linear in the text.

    Returns ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted) and
    ``contaminated``: at least one word hit, and a twentieth of all words or more.

    A null text has no words; null and empty items have no windows; rows with a null key are
    reported unhit; repeated rows are judged one by one and come back as often; an empty
    benchmark hits nothing. Other columns are not read.
    """
    windows = materialize(item_windows(benchmark, item, item_text))
    sizes = [r[0] for r in windows.select("_size").distinct().collect()]  # four at most
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    # places of item shingles in the corpus
    wanted = windows.select(F.explode("_set").alias("_shingle")).distinct()
    per_size = [F.struct(F.lit(s).alias("s"), shingles(F.col("_words"), s).alias("h")) for s in sizes]
    words = rows.filter(F.col("_key").isNotNull()).select("_key", words_of(F.col("_text")).alias("_words"))
    if len(sizes) == 1:
        found = words.select("_key", F.posexplode(shingles(F.col("_words"), sizes[0])).alias("_at", "_shingle"))
    else:
        parts = F.array(*per_size) if sizes else F.array().cast("array<struct<s:int,h:array<bigint>>>")
        found = words.select("_key", F.explode(parts).alias("_p"))
        found = found.select("_key", F.posexplode("_p.h").alias("_at", "_shingle"))
    found = materialize(found.join(within_bound(wanted), "_shingle", "left_semi"))

    # the rarest shingle of every window, and its place in it
    counts = found.groupBy("_shingle").agg(F.count(F.lit(1)).alias("_n"))
    placed = windows.select("_words", "_len", F.posexplode("_set").alias("_offset", "_shingle"))
    placed = placed.join(counts, "_shingle")  # a shingle without a place rules its window out
    whole = placed.groupBy("_words", "_len").agg(
        F.count(F.lit(1)).alias("_there"),
        F.min(F.struct("_n", "_shingle", "_offset")).alias("_first"),
    )
    shingles_of = F.col("_len") - F.least(F.lit(SHINGLE), F.col("_len")) + 1
    prefix = whole.filter(F.col("_there") == shingles_of).select(
        "_words", "_len", F.col("_first._shingle").alias("_shingle"), F.col("_first._offset").alias("_offset")
    )
    candidates = found.join(prefix, "_shingle").select(
        "_key", (F.col("_at") - F.col("_offset")).alias("_start"), "_len", "_words"
    )
    candidates = candidates.filter("_start >= 0").join(windows.select("_words", "_len", "_items"), ["_words", "_len"])
    candidates = candidates.groupBy("_key").agg(
        F.collect_set(F.struct("_start", "_len", "_words", "_items")).alias("_windows")
    )

    # verification on the words themselves
    tested = rows.select("_key", words_of(F.col("_text")).alias("_all")).join(
        candidates, "_key", "left"
    )
    inside = F.filter(
        "_windows",
        lambda w: (w["_start"] + w["_len"] <= F.size("_all"))
        & (F.slice(F.col("_all"), w["_start"] + 1, w["_len"]) == w["_words"]),
    )
    tested = tested.select("_key", F.size("_all").cast("bigint").alias("n_words"), inside.alias("_hits"))
    places = F.flatten(
        F.transform("_hits", lambda w: F.sequence(w["_start"], w["_start"] + w["_len"] - 1))
    )
    hit = F.coalesce(F.size(F.array_distinct(places)).cast("bigint"), F.lit(0).cast("bigint"))
    found_items = F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda w: w["_items"]))))
    tested = tested.select(
        F.col("_key").alias(key),
        "n_words",
        F.when(F.col("_hits").isNull(), 0).otherwise(hit).cast("bigint").alias("n_hit"),
        F.coalesce(found_items, F.array().cast("array<string>")).alias("items"),
    )
    return tested.select(
        key, "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
