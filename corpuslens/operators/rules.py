"""Quality rules, their tiers, and the cascade that applies them.

The rules form one list. Two plans come out of it:

* ``cascade`` labels every row with the first rule it fails, in one ``CASE`` expression;
* ``kept_only`` filters by the conjunction, whose simple comparisons reach the parquet scan.
"""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.text import alphanum_fraction, settle, with_text_stats
from corpuslens.operators.syntax import PYTHON, parses_as_python
from corpuslens.schemas import SLIM, SLIM_FROM_FULL


@dataclass(frozen=True)
class Thresholds:
    """Limits of the quality rules."""

    max_ll: int = 600
    min_len: int = 50
    min_max_ll: int = 25
    max_size_kbs: int = 1000
    min_alphanum: float = 0.001
    max_alphanum: float = 0.975
    min_ave_ll: float = 16
    min_lines: float = 3


# Fixed values, in the order of the fields above.
TIERS = {
    "permissive": Thresholds(1200, 8, 5, 1000, 0.0001, 0.99, 8, 2),
    "moderate": Thresholds(600, 50, 25, 750, 0.001, 0.975, 16, 3),
    "aggressive": Thresholds(300, 100, 32, 500, 0.0025, 0.97, 20, 5),
}

# The reason given by each rule, in the order the rules run.
RULE_REASONS = [
    "max_ll",
    "file_too_small",
    "file_too_large",
    "alphanum_frac",
    "ave_ll",
    "min_lines",
]
SYNTAX_REASON = "python2"


def tier(name: str | Thresholds) -> Thresholds:
    """Thresholds of a tier, whatever the case of its name; own thresholds pass through."""
    if isinstance(name, Thresholds):
        return name
    try:
        return TIERS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown tier {name!r}, use one of {', '.join(TIERS)}") from None


@dataclass(frozen=True)
class Rule:
    reason: str
    holds: Column  # false or null: the row is rejected


def _limit(df: DataFrame, column: str, value: float) -> Column:
    """A threshold in the type of the column it is compared with.

    A double literal next to a 32-bit column would move the boundary: 0.001 as a float is
    larger than 0.001 as a double.
    """
    kind = df.schema[column].dataType if column in df.columns else SLIM[column].dataType
    return F.lit(value).cast(kind)


def rules(df: DataFrame, limits: Thresholds) -> list[Rule]:
    """The rules over the slim columns of ``df``; each needs only the columns it reads.

    Spark orders NaN above every number, so lower bounds on floating columns exclude it
    explicitly; an upper bound already does.
    """
    longest, size = F.col("max_ll"), F.col("file_size")
    share, average = F.col("alphanum_frac"), F.col("ave_ll")
    lines = F.try_divide(size.cast("double"), average.cast("double"))
    conditions = [
        (longest <= limits.max_ll) & (longest >= limits.min_max_ll),
        size >= limits.min_len,
        # whole kilobytes at most max_size_kbs, in the form that is pushed to the scan
        size < (limits.max_size_kbs + 1) * 1024,
        (share > _limit(df, "alphanum_frac", limits.min_alphanum))
        & (share < _limit(df, "alphanum_frac", limits.max_alphanum)),
        (average > _limit(df, "ave_ll", limits.min_ave_ll)) & ~F.isnan(average),
        # the line count is estimated; a positive size over zero counts as infinite
        F.when(average == 0, size > 0).otherwise((lines >= limits.min_lines) & ~F.isnan(lines)),
    ]
    return [Rule(reason, held) for reason, held in zip(RULE_REASONS, conditions, strict=True)]


def first_failure(checks: Iterable[Rule]) -> Column:
    """Reason of the first rule that does not hold, null where all hold."""
    chain = F
    for check in checks:
        chain = chain.when(~F.coalesce(check.holds, F.lit(False)), F.lit(check.reason))
    return chain.otherwise(F.lit(None).cast("string"))


def cascade(
    df: DataFrame,
    limits: Thresholds,
    python_gate: str = "python_only",
    content: str = "content",
    lang: str = "repo_lang",
) -> DataFrame:
    """Add ``reason`` (null for kept rows) and ``verdict`` to every row.

    ``python_gate`` says which rows must also parse as Python: ``python_only``, ``all`` or
    ``off``. Only text of rows that passed the cheap rules travels to the Python workers;
    the other rows send a null, so input is read once and not split and joined again.
    """
    if python_gate not in ("python_only", "all", "off"):
        raise ValueError("python_gate must be 'python_only', 'all' or 'off'")
    out = df.withColumn("reason", first_failure(rules(df, limits)))
    if python_gate != "off":
        gated = F.col("reason").isNull()
        if python_gate == "python_only":
            gated = gated & F.lower(F.col(lang)).isin(list(PYTHON))
        gated = F.coalesce(gated, F.lit(False))
        # settled, or a filter on the verdict would parse every text a second time
        out = settle(out, {"_parses": parses_as_python(F.when(gated, F.col(content)))})
        out = out.withColumn(
            "reason",
            F.when(gated & ~F.col("_parses"), F.lit(SYNTAX_REASON)).otherwise(F.col("reason")),
        ).drop("_parses")
    return out.withColumn("verdict", verdict(F.col("reason")))


def cascade_text(
    df: DataFrame,
    limits: Thresholds,
    python_gate: str = "python_only",
    content: str = "content",
    lang: str = "repo_lang",
) -> DataFrame:
    """``cascade`` over raw text without precomputed statistics.

    The slim statistics are added. Counting letters costs as much as splitting lines, so it
    is done only for rows that pass the rules before it; the others have a null there. Slim
    statistics that the rows have already are replaced; other columns stay as they are, also
    the statistics of full rows.
    """
    stats = ("size", "max_line_length", "avg_line_length")
    df = df.drop("file_size", "max_ll", "ave_ll", "alphanum_frac")
    given = {name: f"_given_{name}" for name in stats if name in df.columns}
    sizes = with_text_stats(df.withColumnsRenamed(given), content, stats)
    measured = sizes.select(
        *[F.col(given.get(name, name)).alias(name) for name in df.columns],
        F.col("size").cast("int").alias("file_size"),
        F.col("max_line_length").cast("int").alias("max_ll"),
        F.col("avg_line_length").cast("float").alias("ave_ll"),
    )
    blank = measured.withColumn("alphanum_frac", F.lit(None).cast("float"))
    before = RULE_REASONS.index("alphanum_frac")
    undecided = first_failure(rules(blank, limits)[:before]).isNull()
    share = F.when(undecided, alphanum_fraction(F.col(content))).cast("float")
    return cascade(settle(measured, {"alphanum_frac": share}), limits, python_gate, content, lang)


def kept_text(df: DataFrame, limits: Thresholds, content: str = "content") -> DataFrame:
    """Rows of raw text that pass all rules, with the slim statistics and no syntax gate.

    Order does not matter where no reason is given, so rows of the wrong size go first and
    are never split into lines.
    """
    size = F.octet_length(content)
    sized = df.filter((size >= limits.min_len) & (size < (limits.max_size_kbs + 1) * 1024))
    labelled = cascade_text(sized, limits, "off", content)
    return labelled.filter(F.col("reason").isNull()).drop("reason", "verdict")


def verdict(reason: Column) -> Column:
    return F.when(reason.isNull(), F.lit("kept")).otherwise(F.lit("rejected"))


def kept_only(df: DataFrame, limits: Thresholds) -> DataFrame:
    """Rows that pass all rules, without the syntax gate and without rejects."""
    for check in rules(df, limits):
        df = df.filter(check.holds)
    return df


def kept_full(
    full: DataFrame, limits: Thresholds, on_overflow: str = "error", also: Iterable[Column] = ()
) -> DataFrame:
    """``kept_only`` over full rows, as slim rows.

    The casts of ``slim`` keep conditions from the scan, so bounds on the stored columns are
    added. Each is implied by its rule: rounding to a float keeps the order, so what is above
    a limit as a float is above it as it was.
    """

    def as_float(value: float) -> Column:
        return F.lit(value).cast("float").cast("double")

    size, longest = F.col("size"), F.col("max_line_length")
    share, average = F.col("alphanum_fraction"), F.col("avg_line_length")
    bounds = [
        (longest <= limits.max_ll) & (longest >= limits.min_max_ll),
        (size >= limits.min_len) & (size < (limits.max_size_kbs + 1) * 1024),
        (share > as_float(limits.min_alphanum)) & (share < as_float(limits.max_alphanum)),
        average > as_float(limits.min_ave_ll),
    ]
    for bound in bounds:
        full = full.filter(bound)
    return kept_only(slim(full, on_overflow, also), limits)


def split(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept rows and rejects of a cascade; every row is in exactly one of them."""
    kept = labelled.filter(F.col("verdict") == "kept").drop("reason", "verdict")
    return kept, labelled.filter(F.col("verdict") == "rejected").drop("verdict")


def slim(
    full: DataFrame, on_overflow: str = "error", also: Iterable[Column] = ()
) -> DataFrame:
    """Project the full corpus to the slim columns in 32-bit types.

    Other columns are dropped, so the scan does not read them. A value that does not fit
    fails the job, or becomes null with ``on_overflow="null"``. ``also`` names further
    columns to keep.
    """
    if on_overflow not in ("error", "null"):
        raise ValueError("on_overflow must be 'error' or 'null'")
    columns = []
    for field in SLIM.fields:
        source = F.col(SLIM_FROM_FULL[field.name])
        cast = source.try_cast if on_overflow == "null" else source.cast
        columns.append(cast(field.dataType).alias(field.name))
    return full.select(*columns, *also)
