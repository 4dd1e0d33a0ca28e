"""Reports on a run: rows left after each rule, and success rates of chunks."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from corpuslens.operators.positions import with_row_index
from corpuslens.operators.rules import RULE_REASONS, SYNTAX_REASON

# Number of blocks the running mean is cut into.
_BLOCKS = 4096


def _steps(syntax_gate: bool) -> list[str]:
    return RULE_REASONS + ([SYNTAX_REASON] if syntax_gate else [])


def _counts(syntax_gate: bool) -> list[Column]:
    steps = [F.count_if(F.col("reason") == step).alias(step) for step in _steps(syntax_gate)]
    return [F.count(F.lit(1)).alias("original"), *steps]


def _rows_left(counts: DataFrame, syntax_gate: bool) -> DataFrame:
    left = F.col("original")
    rows = [F.struct(F.lit(0).alias("step"), F.lit("original").alias("rule"), left.alias("rows_left"))]
    for number, step in enumerate(_steps(syntax_gate), start=1):
        left = left - F.coalesce(F.col(step), F.lit(0))
        rows.append(
            F.struct(F.lit(number).alias("step"), F.lit(step).alias("rule"), left.alias("rows_left"))
        )
    return counts.select(F.inline(F.array(*rows)))


def funnel(labelled: DataFrame, syntax_gate: bool = False) -> DataFrame:
    """Rows left after loading and after each rule, from one pass over the reasons."""
    return _rows_left(labelled.agg(*_counts(syntax_gate)), syntax_gate)


def observed(labelled: DataFrame, syntax_gate: bool = False) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The same rows, counted on their way to wherever they go, and a function that gives their
    funnel after the first job over them. That job does the counting; no other is started."""
    watch = Observation()
    rows = labelled.observe(watch, *_counts(syntax_gate))

    def result() -> DataFrame:
        counts, names = watch.get, ["original", *_steps(syntax_gate)]
        schema = ", ".join(f"{name} bigint not null" for name in names)
        row = labelled.sparkSession.createDataFrame([tuple(counts[name] for name in names)], schema)
        return _rows_left(row, syntax_gate)

    return rows, result


def chunk_success(items: DataFrame, success: Column, chunk: str = "chunk_id") -> DataFrame:
    """Share of successful items of each chunk, in percent."""
    good = F.count_if(success).cast("double")
    return items.groupBy(chunk).agg((good / F.count(F.lit(1)) * 100).alias("success_rate"))


def repo_success(outcomes: DataFrame, count_empty_as_success: bool = True) -> Column:
    """Whether a repository counts as done: it did not fail, and was not empty if that matters.

    Expects the columns ``failed`` and ``n_files``.
    """
    done = ~F.coalesce(outcomes["failed"], F.lit(False))
    return done if count_empty_as_success else done & (outcomes["n_files"] > 0)


def running_mean(
    rates: DataFrame, order_by: str = "chunk_id", value: str = "success_rate"
) -> DataFrame:
    """Mean of all values up to and including each row, by the integer ``order_by``.

    Rows are numbered in order and cut into a fixed number of blocks of equal size, whatever
    their values. Sums run inside a block in parallel, and one small table carries the totals
    of the blocks before; it never has more than that fixed number of rows. Rows without an
    order value stand nowhere: they come back with a null mean and count in no other.
    """
    placed = rates.filter(F.col(order_by).isNotNull())
    placed = with_row_index(placed, [order_by], "_row")  # stored there already
    block = F.expr(f"_row * {_BLOCKS} div greatest(_total, 1)")
    blocked = placed.withColumn("_block", block)
    inside = Window.partitionBy("_block").orderBy("_row")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocked.groupBy("_block").agg(F.sum(value).alias("s"), F.count(value).alias("c"))
    before = totals.select(
        "_block",
        F.coalesce(F.sum("s").over(earlier), F.lit(0.0)).alias("_sum_before"),
        F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("_count_before"),
    )
    summed = blocked.withColumns(
        {"_sum": F.sum(value).over(upto), "_count": F.count(value).over(upto)}
    )
    mean = (F.col("_sum") + F.col("_sum_before")) / (F.col("_count") + F.col("_count_before"))
    ranked = summed.join(F.broadcast(before), "_block").withColumn("running_rate", mean)
    nowhere = rates.filter(F.col(order_by).isNull())
    nowhere = nowhere.withColumn("running_rate", F.lit(None).cast("double"))
    return ranked.select(*rates.columns, "running_rate").unionByName(nowhere)
