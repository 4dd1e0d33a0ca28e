"""Quality rules per document, and a verdict per host by shrunken failure rates.

Native expressions only. All figures of a text come from one pass inside its row; nothing but
a few numbers per document is written or shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 5

BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def window_hashes(words: Column) -> Column:
    """Hash of every five consecutive words."""
    places = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def words_in_repeats(hashes: Column) -> Column:
    """Words covered by windows that occur twice or more, the first occurrence included.

    Sorting the hashes of one text brings equal windows together. Most texts have no repeat,
    which a set of their hashes tells without sorting.
    """
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(item, k):
        own = item["h"]
        before, after = F.get(placed_, k - 1)["h"], F.get(placed_, k + 1)["h"]
        return (own == before).eqNullSafe(True) | (own == after).eqNullSafe(True)

    placed_ = F.col("_placed")
    places = F.sort_array(
        F.transform(F.filter(placed_, repeated), lambda item: item["i"])
    )
    return placed, places


def base_figures(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``keep`` and the five figures of every text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(
        *keep,
        F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)).alias("_words"),
        F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"),
    )
    rows = rows.select(
        *keep,
        "n_symbols",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        window_hashes(F.col("_words")).alias("_hashes"),
    )
    # only rows with a repeated window are sorted
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed, places = words_in_repeats(F.col("_hashes"))
    rows = rows.withColumn("_placed", F.when(repeats, placed)).drop("_hashes")
    rows = rows.withColumn("_places", F.when(F.col("_placed").isNotNull(), places)).drop("_placed")
    following = lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get(F.col("_places"), k + 1) - p, F.lit(WINDOW))
    )
    covered = F.aggregate(
        F.transform("_places", following), F.lit(0).cast("bigint"), lambda a, n: a + n
    )
    return rows.select(
        *keep, *BASE_COLUMNS[:-1], F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words")
    )


def host_quality(
    docs: DataFrame,
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
    min_words: int = 10,
    max_repeat_percent: int = 20,
    max_host_rate: float = 0.5,
) -> DataFrame:
    """Figures of every document, whether it fails the base rules, and the final verdict.

    The base rules fail a text with fewer than ``min_words`` words, or with more than
    ``max_repeat_percent`` of its words in repeated five-word windows. Failures are counted
    per host, partly before the shuffle, so a host with a third of all rows is no hot spot.
    A beta prior is fitted to the rates of all hosts by their mean and variance; the rate of
    each host is shrunk towards it, so that a host with two documents is not condemned by
    one. A host whose shrunken rate exceeds ``max_host_rate`` loses all its documents. Only
    condemned hosts are joined back, on rows of a few numbers.

    A null text has no words and fails; rows without a host form one host of their own; a
    null key and repeated rows are judged like any other row; an empty table gives no rows.
    Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(host).alias("_host"), F.col(text).alias("_text"))
    figures = base_figures(rows, ["_key", "_host"], "_text")
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    figures = materialize(figures.withColumn("base_failed", failed))

    hosts = figures.groupBy("_host").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("base_failed").alias("_bad")
    )
    rate = F.col("_bad") / F.col("_n")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()
    mean, variance = prior["m"] or 0.0, prior["v"] or 0.0
    # hosts that are all alike: as strong a prior as a hundred documents
    strength = mean * (1 - mean) / variance - 1 if variance > 0 else 100.0
    strength = min(max(strength, 1.0), 1e6)
    shrunk = (F.col("_bad") + mean * strength) / (F.col("_n") + strength)
    condemned = hosts.select(F.col("_host").alias("_bad_host"), shrunk.alias("_rate"))
    condemned = condemned.filter(F.col("_rate") > max_host_rate).withColumn("_gone", F.lit(True))
    judged = figures.join(condemned, F.col("_host").eqNullSafe(F.col("_bad_host")), "left")
    return judged.select(
        F.col("_key").alias(key),
        *BASE_COLUMNS,
        "base_failed",
        (~F.col("base_failed") & F.col("_gone").isNull()).alias("kept"),
    )
