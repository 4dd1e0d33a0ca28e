import math
import random

import numpy as np
import pytest

from corpuslens import schemas
from corpuslens.functions.text import with_text_stats
from corpuslens.operators import reports, rules
from corpuslens.operators.rules import TIERS, Thresholds
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYED = T.StructType([T.StructField("id", T.LongType())] + schemas.SLIM.fields)
GOOD = {"file_size": 2000, "max_ll": 80, "ave_ll": 30.0, "alphanum_frac": 0.7}


def slim_rows(spark, changes):
    rows = []
    for number, change in enumerate(changes):
        row = {"repo_name": "a/b", "file_ext": "py", "content": "x = 1", "repo_lang": "Go"}
        row |= GOOD | change
        rows.append((number, *[row[f.name] for f in schemas.SLIM.fields]))
    return spark.createDataFrame(rows, KEYED)


def reasons(spark, changes, limits=TIERS["moderate"], gate="off"):
    out = rules.cascade(slim_rows(spark, changes), limits, gate)
    return [r["reason"] for r in out.orderBy("id").collect()]


def expected_reason(row, limits):
    """The rules spelled out row by row in 32-bit arithmetic."""
    size, longest = row["file_size"], row["max_ll"]
    average = None if row["ave_ll"] is None else np.float32(row["ave_ll"])
    share = None if row["alphanum_frac"] is None else np.float32(row["alphanum_frac"])
    if longest is None or not limits.min_max_ll <= longest <= limits.max_ll:
        return "max_ll"
    if size is None or size < limits.min_len:
        return "file_too_small"
    if size // 1024 > limits.max_size_kbs:
        return "file_too_large"
    low, high = np.float32(limits.min_alphanum), np.float32(limits.max_alphanum)
    if share is None or not (share > low and share < high):
        return "alphanum_frac"
    if average is None or not average > np.float32(limits.min_ave_ll):
        return "ave_ll"
    lines = math.inf if average == 0 else float(size) / float(average)
    return None if lines >= limits.min_lines else "min_lines"


@pytest.mark.parametrize("name", [*TIERS, "default"])
def test_bounds(spark, name):
    limits = TIERS.get(name, Thresholds())
    changes = []
    for bound in (limits.min_max_ll, limits.max_ll):
        changes += [{"max_ll": bound + d} for d in (-1, 0, 1)]
    for size in (limits.min_len, (limits.max_size_kbs + 1) * 1024):
        changes += [{"file_size": size + d} for d in (-1, 0, 1)]
    for share in (0, 0.0001, 0.001, 0.0025, 0.97, 0.975, 0.99, 1):
        exact = np.float32(share)
        near = [np.nextafter(exact, np.float32(d), dtype=np.float32) for d in (-1, 2)]
        changes += [{"alphanum_frac": float(v)} for v in (exact, *near)]
    least = np.float32(limits.min_ave_ll)
    changes += [
        {"ave_ll": float(v)}
        for v in (least, np.nextafter(least, np.float32(0)), np.nextafter(least, np.float32(99)))
    ]
    # estimated line count just under, at and above the limit
    changes += [
        {"file_size": limits.min_lines * 64 + d, "ave_ll": 64.0} for d in (-1, 0, 1)
    ]
    missing = ("file_size", "max_ll", "ave_ll", "alphanum_frac")
    changes += [{column: None} for column in missing]
    got = reasons(spark, changes, limits)
    assert got == [expected_reason(GOOD | c, limits) for c in changes]


@pytest.mark.parametrize("name", TIERS)
def test_random_rows_against_the_rules_spelled_out(spark, name):
    limits, draw = TIERS[name], random.Random(11)
    near = {
        "max_ll": [None, 0, limits.min_max_ll - 1, limits.min_max_ll, limits.max_ll, limits.max_ll + 1],
        "file_size": [None, 0, limits.min_len, 1023, 40_000, limits.max_size_kbs * 1024 + 1023, 2**30],
        "alphanum_frac": [None, float("nan"), 0.0, limits.min_alphanum, 0.5, limits.max_alphanum, 1.0],
        "ave_ll": [None, float("nan"), 0.0, float(limits.min_ave_ll), limits.min_ave_ll + 0.5, 33.3, 1e6],
    }
    weights = {column: [1] * 3 + [12] * (len(values) - 3) for column, values in near.items()}
    changes = [
        {column: draw.choices(values, weights[column])[0] for column, values in near.items()}
        for _ in range(1500)
    ]
    want = [expected_reason(GOOD | c, limits) for c in changes]
    assert len(set(want)) == 7
    rows = slim_rows(spark, changes)
    out = rules.cascade(rows, limits, "off").orderBy("id").select("reason")
    assert [r[0] for r in out.collect()] == want
    kept = {r["id"] for r in rules.kept_only(rows, limits).select("id").collect()}
    assert kept == {n for n, reason in enumerate(want) if reason is None}


def test_nan_fails_the_first_rule_that_reads_it(spark):
    nan = float("nan")
    assert reasons(spark, [{"ave_ll": nan}, {"alphanum_frac": nan}]) == ["ave_ll", "alphanum_frac"]


def test_each_rule_alone_rejects_missing_values(spark):
    nan = float("nan")
    rows = slim_rows(
        spark,
        [{"ave_ll": nan}, {"ave_ll": None}, {"ave_ll": 0.0}, {"ave_ll": 0.0, "file_size": 0}],
    )
    by_reason = {r.reason: r for r in rules.rules(rows, TIERS["moderate"])}
    held = F.coalesce(by_reason["min_lines"].holds, F.lit(False))
    got = [r[0] for r in rows.orderBy("id").select(held).collect()]
    assert got == [False, False, True, False]


def test_first_failed_rule_wins(spark):
    assert reasons(spark, [{"max_ll": 9999, "file_size": 1}, {"file_size": 1, "ave_ll": 1.0}]) == [
        "max_ll",
        "file_too_small",
    ]


def test_double_columns_are_compared_as_doubles(spark):
    rows = slim_rows(spark, [{}]).withColumn("alphanum_frac", F.lit(float(np.float32(0.001))))
    out = rules.cascade(rows, TIERS["moderate"], "off").first()
    # as a double, the 32-bit value of 0.001 lies above 0.001
    assert out["reason"] is None


def test_kept_only_agrees_with_cascade_and_is_pushed(spark, tmp_path):
    changes = [
        {}, {"max_ll": 1}, {"file_size": 3}, {"file_size": 10**9}, {"alphanum_frac": 1.0},
        {"ave_ll": 1.0}, {"ave_ll": float("nan")}, {"ave_ll": 900.0, "file_size": 1000},
        {"ave_ll": None}, {"max_ll": None}, {"ave_ll": 20.0},
    ]
    path = str(tmp_path / "slim")
    slim_rows(spark, changes).write.parquet(path)
    stored = spark.read.parquet(path)
    for limits in (*TIERS.values(), Thresholds()):
        kept = {r["id"] for r in rules.kept_only(stored, limits).collect()}
        labelled, rejected = rules.split(rules.cascade(stored, limits, "off"))
        assert kept == {r["id"] for r in labelled.collect()}
        assert kept | {r["id"] for r in rejected.collect()} == set(range(len(changes)))
    plan = rules.kept_only(stored, TIERS["moderate"])._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    for column in ("max_ll", "file_size", "alphanum_frac", "ave_ll"):
        assert column in pushed


BODIES = [
    "x" * 30 + "\n" + "word, " * 20 + "\n" + "y" * 40, "", None, "short", "-" * 60 + "\n" * 3, "a b\n" * 40,
    "w" * 700, "\n".join(["alpha beta gamma delta epsilon"] * 30), "é€\r\n" * 50 + "z" * 40,
]


@pytest.mark.parametrize("name", TIERS)
def test_raw_text_gives_the_same_labels(spark, name):
    limits = TIERS[name]
    rows = spark.createDataFrame(list(enumerate(BODIES)), "id bigint, content string").withColumn("repo_lang", F.lit("Go"))
    stats = with_text_stats(rows)
    slim = stats.select(
        "id", "content", "repo_lang", F.col("size").cast("int").alias("file_size"),
        F.col("max_line_length").cast("int").alias("max_ll"),
        F.col("avg_line_length").cast("float").alias("ave_ll"),
        F.col("alphanum_fraction").cast("float").alias("alphanum_frac"),
    )
    want = {r["id"]: r["reason"] for r in rules.cascade(slim, limits, "off").collect()}
    got = {r["id"]: r for r in rules.cascade_text(rows, limits).collect()}
    assert {i: r["reason"] for i, r in got.items()} == want
    kept = rules.kept_text(rows, limits)
    assert {tuple(r) for r in kept.collect()} == {
        tuple(r) for r in slim.select(kept.columns).filter(F.col("id").isin([i for i in want if want[i] is None])).collect()
    }


def test_tier_names():
    assert rules.tier("MoDerate") is TIERS["moderate"]
    with pytest.raises(ValueError, match="unknown tier"):
        rules.tier("strict")


PROGRAMS = [
    ("x = 1\n", True),
    ("print 'x'\n", False),
    ("a = 1\x00", False),
    ("def f(:\n", False),
    ("", True),
    ("(" * 300 + ")" * 300, False),
    (None, False),
    ("# comment only", True),
    ("match x:\n    case 1: pass\n", True),
]


@pytest.mark.parametrize("gate", ["python_only", "all", "off"])
def test_syntax_gate(spark, gate):
    changes = [{"content": text, "repo_lang": "Python"} for text, _ in PROGRAMS]
    changes += [{"content": text, "repo_lang": "Go"} for text, _ in PROGRAMS]
    changes += [{"content": "print 'x'", "repo_lang": None}]
    fails = [None if parses else "python2" for _, parses in PROGRAMS]
    none = [None] * len(PROGRAMS)
    expected = {
        "python_only": fails + none + [None],
        "all": fails + fails + ["python2"],
        "off": none + none + [None],
    }
    assert reasons(spark, changes, gate=gate) == expected[gate]


def test_syntax_gate_only_sees_rows_that_passed(spark):
    rows = slim_rows(spark, [{"content": "print 'x'", "repo_lang": "python", "max_ll": 1}])
    out = rules.cascade(rows, TIERS["moderate"], "all")
    assert out.first()["reason"] == "max_ll"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "isnull(reason" in plan
    for side in rules.split(out):
        assert side._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    plain = rules.cascade(rows, TIERS["moderate"], "off")
    assert "Python" not in plain._jdf.queryExecution().executedPlan().toString()


def test_unknown_gate(spark):
    with pytest.raises(ValueError):
        rules.cascade(slim_rows(spark, [{}]), TIERS["moderate"], "sometimes")


def test_funnel_with_syntax_step(spark):
    changes = [{}, {"max_ll": 1}, {"content": "print 'x'"}, {"ave_ll": 1.0}]
    out = rules.cascade(slim_rows(spark, changes), TIERS["moderate"], "all")
    got = [(r["rule"], r["rows_left"]) for r in reports.funnel(out, True).orderBy("step").collect()]
    assert got == [
        ("original", 4), ("max_ll", 3), ("file_too_small", 3), ("file_too_large", 3),
        ("alphanum_frac", 3), ("ave_ll", 2), ("min_lines", 2), ("python2", 1),
    ]


def test_slim_overflow(spark):
    full = spark.createDataFrame(
        [("r", "py", "x", 2**40, 1, 1.0, 0.5, "Go")],
        "max_stars_repo_name string, ext string, content string, size bigint, "
        "max_line_length bigint, avg_line_length double, alphanum_fraction double, lang string",
    )
    assert rules.slim(full, "null").first()["file_size"] is None
    with pytest.raises(Exception, match="overflow|OVERFLOW"):
        rules.slim(full).collect()
    assert rules.slim(full).schema == schemas.SLIM


def test_raw_text_of_full_rows_keeps_their_columns(spark):
    rows = spark.createDataFrame([("a b\n" * 9, 7, 1, "x")], "content string, size long, max_ll int, repo_lang string")
    out = rules.cascade_text(rows, rules.tier("permissive"), "off").first()
    assert (out["size"], out["file_size"], out["max_ll"]) == (7, 36, 3)


def test_kept_full_pushes_bounds_and_agrees_with_the_cascade(spark, tmp_path):
    limits = rules.tier("moderate")
    near = lambda v: [v, float(np.float32(v)), np.nextafter(v, 0), np.nextafter(np.float64(np.float32(v)), 1)]
    shares = [float(v) for v in [*near(limits.min_alphanum), *near(limits.max_alphanum), 0.5, float("nan")]] + [None]
    rows = [
        ("o/r", "txt", "x", size, longest, average, share, "c")
        for size in (49, 50, 751 * 1024 - 1, 751 * 1024, None)
        for longest in (24, 25, 600, 601)
        for average in (16.0, 16.0000001, 16.5, float("nan"))
        for share in shares
    ]
    names = "max_stars_repo_name string, ext string, content string, size long, max_line_length long, "
    names += "avg_line_length double, alphanum_fraction double, lang string"
    path = str(tmp_path / "full")
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(path)
    full = spark.read.parquet(path)
    kept = rules.kept_full(full, limits)
    labelled = rules.cascade(rules.slim(full), limits, "off").filter("reason is null")
    columns = ["file_size", "max_ll", "ave_ll", "alphanum_frac"]
    want = sorted(map(tuple, labelled.select(columns).collect()))
    assert want and sorted(map(tuple, kept.select(columns).collect())) == want
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = rules.kept_full(full, limits)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    for bound in ("GreaterThanOrEqual(size,50)", "LessThan(size,", "LessThanOrEqual(max_line_length,600)",
                  "GreaterThan(alphanum_fraction,", "LessThan(alphanum_fraction,", "GreaterThan(avg_line_length,16.0)"):
        assert bound in pushed
