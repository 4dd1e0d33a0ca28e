"""From raw documents to packed sequences: each stage works on all that the one before kept.

A stage reads ``doc_id`` and ``text`` and carries every other column along under a name of its
own, whatever its name and type. In all stages a null text is an empty one, rows without ``doc_id``
are compared with no other row and come back with their texts unless they are toxic, an empty
table gives no rows, and long texts are worked on as a whole. Stages limit the bytes of the
session's Arrow batches, see ``small_batches``; ``run`` puts the limit back.
"""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm import (
    cutting_stock,
    decontamination,
    jaccard_join,
    substring_dedup,
    tokens,
    toxicity,
)
from corpuslens.llm.queries import fold, table
from corpuslens.session import BATCH_BYTES, materialize, small_batches


def bounded(stage: Callable) -> Callable:
    """``stage`` with small Arrow batches: whole texts go to Python workers in each of them."""

    @wraps(stage)
    def run_bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_bounded


def renamed(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The table under plain column names, and those of ``doc_id`` and ``text``."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names[docs.columns.index("doc_id")], names[docs.columns.index("text")]


def named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows``, under plain names, with the names of ``docs``."""
    return rows.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


@bounded
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject.

    Empty texts are scored by their length alone; repeated rows are scored alike.
    """
    rows, key, text = renamed(docs)
    scored = toxicity.score_toxicity(
        rows,
        table(spark, sf_dir, "labels").withColumnRenamed("doc_id", key),
        learn=F.col(key).isNotNull() & (fold(key, 5) != 0),
        key=key,
        text=text,
        keep=[F.col(c) for c in rows.columns],
    )
    return named(scored.filter("predicted = 0"), docs)


@bounded
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group linked by a similarity of 0.8 of five-word shingles.

    Of several rows with one doc_id the least by its columns stays; rows without one all stay,
    and so do documents without words.
    """
    rows, key, text = renamed(docs)
    groups = jaccard_join.jaccard_components(rows, key, text, percent=80, words=5)
    ids = groups.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min("component_id").alias("first")
    )
    odd = materialize(ids.filter((F.col("n") > 1) | (F.col("first") != F.col(key))))
    several = rows.join(odd.filter(F.col("first") == F.col(key)).select(key), key, "left_semi")
    # structures with maps have no order, but their text has
    row = F.struct(*rows.columns)
    least = several.groupBy(F.col(key).alias("_key")).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    rest = rows.join(odd.select(key), key, "left_anti").select(*rows.columns)
    return named(rest.unionByName(least), docs)


@bounded
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand earlier already; untouched texts stay as they are.

    A document of which nothing is left has an empty text. Repeated rows are one document: what
    one loses, all lose. ``n_chars`` follows the text where the table has such a column.
    """
    rows, key, text = renamed(docs)
    others = [c for c in rows.columns if c not in (key, text)]
    cut = substring_dedup.remove_repeated_words(rows, key, text, carry=others, as_is=True)
    cut = cut.withColumnRenamed("kept", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn(f"c{docs.columns.index('n_chars')}", F.length(text).cast(kind))
    return named(cut, docs)


@bounded
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    Of repeated rows all go if one is contaminated; documents without words stay.
    """
    rows, key, _ = renamed(docs)
    found = decontamination.decontaminate(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    bad = found.filter("contaminated").select(F.col("doc_id").alias(key)).distinct()
    return named(rows.join(bad, key, "left_anti"), docs)


@bounded
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences; an empty text is one token."""
    return cutting_stock.pack_cutting_stock(docs.select("doc_id", "text"), tokens.default_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Tokens and learnt scores cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written and read by the next."""
    rows, before = table(spark, sf_dir, "documents"), spark.conf.get(BATCH_BYTES)
    try:
        for _, stage in STAGES:
            rows = materialize(stage(spark, rows, sf_dir))
    finally:
        spark.conf.set(BATCH_BYTES, before)
    return rows
