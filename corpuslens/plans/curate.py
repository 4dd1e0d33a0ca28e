"""Corpus curation from a parquet tree to kept rows, rejects and a file table."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.operators import languages, reports, rules, syntax
from corpuslens.session import materialize
from corpuslens.sources import readers, writers


@dataclass(frozen=True)
class LanguageChoice:
    """Which languages to curate; see ``languages.select_languages``."""

    top_k: int | None = None
    mb_size_thresh: float | None = None
    pq_file_cnt_thresh: int | None = None
    bad_langs: tuple[str, ...] = languages.DEFAULT_BAD_LANGS
    rank_by: str = "size"


def selected_files(
    spark: SparkSession, root: str, choice: LanguageChoice = LanguageChoice()
) -> DataFrame:
    """File table of a corpus tree with language totals, restricted to the choice.

    Files are listed once; the listing is kept as a table and read several times. A tree
    without parquet files is an error.
    """
    listing = materialize(readers.list_corpus(spark, root))
    if listing.isEmpty():
        raise FileNotFoundError(f"no parquet file below {root}")
    meta = languages.with_language_totals(listing)
    meta = meta.select("pq_path", "lang", "lang_size_mb", "lang_file_cnt")
    return languages.select_languages(
        meta,
        choice.top_k,
        choice.mb_size_thresh,
        choice.pq_file_cnt_thresh,
        choice.bad_langs,
        choice.rank_by,
    )


def label_corpus(
    spark: SparkSession,
    root: str,
    tier: str | rules.Thresholds = "permissive",
    choice: LanguageChoice = LanguageChoice(),
    is_slim: bool = False,
    python_gate: str = "python_only",
) -> DataFrame:
    """Every row of the chosen languages with ``reason`` and ``verdict``.

    Languages are chosen from the file listing, and only their directories are read.
    ``python_gate`` is that of ``rules.cascade``, by the language in each row, or
    ``python_directories``: then all rows of a directory named Python, in any case, must parse,
    and no others. It has a scan of its own, so rows of other directories meet no Python worker.
    """
    files = selected_files(spark, root, choice)
    return _label(spark, root, files, rules.tier(tier), is_slim, python_gate)


def _label(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    limits: rules.Thresholds,
    is_slim: bool,
    python_gate: str,
) -> DataFrame:
    folders = _directories(files)
    if not folders:
        gate = "off" if python_gate == "python_directories" else python_gate
        return rules.cascade(readers.empty_corpus_tree(spark), limits, gate)
    if python_gate == "python_directories":
        parsed = [f for f in folders if _language(f).lower() in syntax.PYTHON]
        parts = [(parsed, "all"), ([f for f in folders if f not in set(parsed)], "off")]
    else:
        parts = [(folders, python_gate)]
    labelled = []
    for chosen, gate in parts:
        if chosen:
            rows = readers.scan_corpus_tree(spark, chosen, is_slim)
            # a directory is read with all below it, which may be of another language
            rows = rows.filter(F.col("lang").isin(sorted({_language(f) for f in chosen})))
            labelled.append(rules.cascade(rows, limits, gate))
    return reduce(DataFrame.unionByName, labelled)


def _language(folder: str) -> str:
    return folder.rsplit("/", 1)[-1]


def _directories(files: DataFrame) -> list[str]:
    """Directories of the listed files. A scan keeps the paths of all its files on the driver, of
    which these are the folders."""
    folder = F.regexp_extract("pq_path", "^(.*)/[^/]*$", 1).alias("folder")
    return sorted(row[0] for row in files.select(folder).distinct().collect())


def curate(
    spark: SparkSession,
    root: str,
    output: str,
    tier: str | rules.Thresholds = "permissive",
    choice: LanguageChoice = LanguageChoice(),
    is_slim: bool = False,
    python_gate: str = "python_only",
    mode: str = "errorifexists",
    rebalance: bool = False,
    keep_origin: bool = True,
) -> DataFrame:
    """Curate a corpus tree: one scan, one partitioned write, one file table.

    Writes ``<output>/rows`` and ``<output>/filtered_meta`` and returns the file table,
    in which ``filtered_pq_path`` names the directory with the kept rows of a file.
    """
    return curate_with_funnel(
        spark, root, output, tier, choice, is_slim, python_gate, mode, rebalance, keep_origin
    )[0]


def curate_with_funnel(
    spark: SparkSession,
    root: str,
    output: str,
    tier: str | rules.Thresholds = "permissive",
    choice: LanguageChoice = LanguageChoice(),
    is_slim: bool = False,
    python_gate: str = "python_only",
    mode: str = "errorifexists",
    rebalance: bool = False,
    keep_origin: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``curate``, and the rows left after loading and after each rule (``reports.funnel``).

    Rows are counted while they are written, so the corpus is still scanned once.
    """
    out = output.rstrip("/")
    limits = rules.tier(tier)
    files = materialize(selected_files(spark, root, choice))
    labelled = _label(spark, root, files, limits, is_slim, python_gate)
    labelled, funnel = reports.observed(labelled, syntax_gate=python_gate != "off")
    writers.write_curated(labelled, f"{out}/rows", mode, rebalance, keep_origin)
    target = writers.kept_directory(f"{out}/rows", F.col("lang"))
    files = files.withColumn("filtered_pq_path", target)
    writers.write_file_table(files, f"{out}/filtered_meta", mode)
    table = spark.read.schema(files.schema).option("header", True).csv(f"{out}/filtered_meta")
    return table, funnel()
