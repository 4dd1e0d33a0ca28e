import random
import re

import pandas as pd
import pytest
from corpuslens.functions import decoding, markers, paths, text
from corpuslens.operators import dedup
from pyspark.sql import functions as F


def frame(spark, values, name="text"):
    return spark.createDataFrame(list(enumerate(values)), f"id bigint, {name} string")


def column(spark, values, build):
    rows = frame(spark, values).select("id", build(F.col("text")).alias("out"))
    return [r["out"] for r in rows.orderBy("id").collect()]


BREAKS = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]
TEXTS = (
    ["", "a", "\n", "\n\n", "a\n", "a\n\n", "\na", "a\r\n\r\nb", "a\n\rbc", "\x1fa", "é\u2028\U0001F600x"]
    + [f"ab{b}c" for b in BREAKS]
    + [f"ab{b}{b}cde{b}" for b in BREAKS]
)


@pytest.fixture(scope="module")
def code_points(spark):
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    return spark.createDataFrame(pd.DataFrame({"cp": points, "ch": [chr(c) for c in points]}))


def test_line_statistics_follow_python(spark):
    rows = text.with_text_stats(frame(spark, TEXTS), "text").orderBy("id").collect()
    for body, row in zip(TEXTS, rows, strict=True):
        lines = body.splitlines()
        assert row["max_line_length"] == max(map(len, lines), default=0)
        assert row["avg_line_length"] == (sum(map(len, lines)) / len(lines) if lines else 0)
        assert row["size"] == len(body.encode())
        share = sum(c.isalnum() for c in body) / len(body) if body else 0
        assert row["alphanum_fraction"] == share
    assert column(spark, TEXTS, text.max_line_length) == [
        max(map(len, t.splitlines()), default=0) for t in TEXTS
    ]


def random_texts(count, seed):
    draw = random.Random(seed)
    alphabet = BREAKS + list("aZ09_-.,;(){}\"'\\ \t") + list("éßñ中文ⅣⅫ²½\u0301\xa0\u3000\u200b\ufeff") + [
        "\U0001F600", "\U00020000", "\x00", "\x1f", "\x7f", "b'", "ab" * 5,
    ]
    return ["".join(draw.choices(alphabet, k=draw.randrange(60))) for _ in range(count)]


def test_random_texts_follow_python(spark):
    bodies = random_texts(800, seed=3)
    rows = text.with_text_stats(frame(spark, bodies), "text")
    rows = rows.withColumn("stripped", text.remove_whitespace(F.col("text"))).orderBy("id").collect()
    for body, row in zip(bodies, rows, strict=True):
        lines = body.splitlines()
        assert row["max_line_length"] == max(map(len, lines), default=0)
        assert row["avg_line_length"] == (sum(map(len, lines)) / len(lines) if lines else 0)
        assert row["alphanum_fraction"] == (sum(map(str.isalnum, body)) / len(body) if body else 0)
        assert row["stripped"] == re.sub(r"\s+", "", body)


@pytest.mark.parametrize("only", [("size",), ("alphanum_fraction",), ("avg_line_length", "size")])
def test_only_some_statistics(spark, only):
    rows = frame(spark, TEXTS)
    some = text.with_text_stats(rows, "text", only).orderBy("id")
    assert some.columns == ["id", "text", *only]
    every = text.with_text_stats(rows, "text").orderBy("id").select(some.columns)
    assert some.collect() == every.collect()
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert ("split(" in plan) == ("avg_line_length" in only)
    assert ("regexp_replace" in plan) == ("alphanum_fraction" in only)


def test_missing_text_has_no_statistics(spark):
    row = text.with_text_stats(frame(spark, [None]), "text").first()
    assert [row[c] for c in ("size", "max_line_length", "avg_line_length", "alphanum_fraction")] == [None] * 4


def test_every_code_point_breaks_lines_like_python(code_points):
    body = F.concat(F.lit("ab"), "ch", F.lit("c"))
    got = code_points.filter(text.max_line_length(body) == 2).select("cp").collect()
    assert {r[0] for r in got} == {
        c for c in range(0x110000) if len(f"ab{chr(c)}c".splitlines()) == 2
    }


def test_every_code_point_of_white_space(code_points):
    got = code_points.filter(text.remove_whitespace(F.col("ch")) == "").select("cp").collect()
    assert {r[0] for r in got} == {c for c in range(0x110000) if re.match(r"\s", chr(c))}


def test_every_assigned_code_point_is_alphanumeric_as_in_python(code_points):
    known = code_points.filter(~F.rlike("ch", F.lit(r"\p{Cn}")))
    got = known.select("cp", (text.alphanum_fraction(F.col("ch")) == 1.0).alias("alnum")).collect()
    assert len(got) > 250_000
    assert [r["cp"] for r in got if r["alnum"] != chr(r["cp"]).isalnum()] == []


def test_filters_do_not_repeat_text_work(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, TEXTS).write.parquet(path)
    stats = text.with_text_stats(spark.read.parquet(path), "text")
    plan = stats.filter("max_line_length > 1 and avg_line_length > 1")._jdf.queryExecution()
    assert plan.executedPlan().toString().count("split(") == 1


@pytest.mark.parametrize("unit,factor", [("KB", 1024), ("MB", 1024**2), ("GB", 1024**3), ("mb", 1), ("x", 1)])
def test_text_size(spark, unit, factor):
    got = column(spark, ["abc", "é" * 2048], lambda c: text.text_size(F.length(c), unit))
    assert got == [3 / factor, 2048 / factor]


def test_byte_size_units(spark):
    row = spark.range(1).select(*[text.byte_size(F.lit(2**30), u).alias(u) for u in ("B", "kb", "Mb", "GB")])
    assert tuple(row.first()) == (2**30, 2**20, 2**10, 1)
    with pytest.raises(ValueError):
        text.byte_size(F.lit(1), "TB")


def test_byte_strings(spark):
    run = lambda n: "b'" + "é" * n + "'"
    bodies = [run(99), run(100), f"x {run(101)} y", "b'" + "a" * 200 + "'", run(100) + run(120),
              "b'" + "\U0001F600" * 100 + "'"]
    token = r"<$1\x>"
    want = [re.sub(r"b'([^\x00-\x7F]{100,})'", lambda m: token, b) for b in bodies]
    assert column(spark, bodies, lambda c: text.replace_byte_strings(c, token=token)) == want
    default = column(spark, bodies[1:2], text.replace_byte_strings)
    assert default == ["<BYTE_ENCODED_STRING>"]


@pytest.mark.parametrize("piece", ["ab", ".", "a*", "(", "\\", "é"])
@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_repeats(spark, piece, n):
    bodies = [piece * 2, piece * 3, f"{piece}X{piece}", "aaa", "", f"xx{piece * 4}"]
    want = [bool(re.search(f"({re.escape(piece)}){{{n},}}", b)) for b in bodies]
    assert column(spark, bodies, lambda c: text.has_repeat(c, piece, n)) == want


def test_negative_repeat():
    with pytest.raises(ValueError):
        text.has_repeat(None, "a", -1)


def test_markers(spark):
    listed = markers.all_markers()
    assert len(listed) == 25 and [len(v) for v in markers.MARKERS.values()] == [1, 2, 1, 21]
    bodies = [f"x {m} y" for m in listed] + [m.swapcase() for m in listed] + ["", None]
    bodies.append(listed[0] + listed[1])
    want = [b is not None and any(m in b for m in listed) for b in bodies]
    assert column(spark, bodies, markers.is_generated) == want
    found = column(spark, bodies, markers.matching_markers)
    assert found[-1] == listed[:2]
    assert all(m in f for m, f in zip(listed, found))
    groups = column(spark, bodies, markers.matching_groups)
    assert groups[-1] == ["django", "protobuf"] and groups[25] == []
    assert column(spark, bodies, lambda c: markers.is_generated(c, ["microsoft"]))[3] is True


NAMES = [
    "a.py", "a.min.js", ".env", "LICENSE", "LICENSE.md", "x.gitattributes", "node_modules", "log",
    "lock", "a.PNG", "a.png", "a.ts", "a.b.csv", "node_modules/m.js", "src/.hidden", "Makefile",
    "my.github.txt", "src/deep/m.go", "a.license", "__init__.py",
]


def valid(name, searched, extra=()):
    base = name.rsplit("/", 1)[-1]
    parts = (".git", "LICENSE", "node_modules", ".min.")
    blocked = set(paths.BLOCKED_EXTENSIONS) | set(extra)
    return base[0] != "." and not any(p in searched for p in parts) and base.split(".")[-1] not in blocked


def test_file_names(spark):
    assert len(paths.BLOCKED_EXTENSIONS) == len(set(paths.BLOCKED_EXTENSIONS)) == 85
    got = column(spark, NAMES, paths.has_valid_name)
    assert got == [valid(n, n.rsplit("/", 1)[-1]) for n in NAMES]
    assert dict(zip(NAMES, got))["node_modules/m.js"]
    by_path = column(spark, NAMES, lambda c: paths.has_valid_name(c, ["go"], "path"))
    assert by_path == [valid(n, n, ["go"]) for n in NAMES]
    assert column(spark, NAMES, paths.extension) == [n.split(".")[-1] for n in NAMES]
    with pytest.raises(ValueError):
        paths.has_valid_name(F.lit("a"), match_on="tree")


def test_download_plan(spark):
    url = "https://host/data/c++/part-0.parquet?x=1"
    row = paths.plan_downloads(spark.createDataFrame([(url,)], "url string"), "/lake/").first()
    assert tuple(row) == (url, "c++", "part-0.parquet?x=1", "/lake/c++/part-0.parquet?x=1")


def test_length_gates(spark):
    bodies = ["x" * n for n in (0, 15, 16, 1048576, 1048577)] + [None]
    assert column(spark, bodies, text.keep_text) == [False, False, True, True, False, False]
    lines = frame(spark, ["a" * 999, "a" * 1000, "b\n" + "a" * 1000, ""])
    assert sorted(r["id"] for r in text.filter_max_line_length(lines).collect()) == [0, 3]
    sizes = frame(spark, ["a" * 1048575, "a" * 1048576])
    assert [r["id"] for r in text.filter_max_text_size(sizes).collect()] == [0]


def test_flatten(spark):
    rows = spark.createDataFrame([(1, [["a"], [], ["b", "c"]]), (2, [])], "id int, nested array<array<string>>")
    got = rows.orderBy("id").select(text.flatten_lists(F.col("nested"))).collect()
    assert [r[0] for r in got] == [["a", "b", "c"], []]
    exploded = text.explode_lists(rows, "nested").orderBy("pos").collect()
    assert [tuple(r) for r in exploded] == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c")]


def test_duplicates_need_an_order(spark):
    rows = spark.createDataFrame([(None, "a b"), (1, "x")], "id int, text string")
    with pytest.raises(ValueError):
        dedup.drop_duplicate_texts(rows, "id")


def test_utf32_is_told_from_utf16(spark):
    texts = ["h\u00e9llo \U0001f600", "\u4e2d"]
    rows = [(m + t.encode(c),) for t in texts for m, c in (
        (b"\xff\xfe\0\0", "utf-32-le"), (b"\0\0\xfe\xff", "utf-32-be"),
        (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))]
    out = spark.createDataFrame(rows, "c binary").select(
        decoding.decode_text(F.col("c")).alias("t"), decoding.is_text(F.col("c")).alias("ok")
    )
    assert [tuple(r) for r in out.collect()] == [(t, True) for t in texts for _ in range(4)]


def test_duplicates_ignore_white_space(spark):
    bodies = ["a b", "ab", "a\xa0b", "a\u3000b\x1c", "\tab\n", "a b c", "abc", "", " \n", "x"]
    bodies += ["hot text"] * 50
    rows = frame(spark, bodies)
    want, seen = [], set()
    for number, body in enumerate(bodies):
        key = re.sub(r"\s+", "", body)
        if key not in seen:
            seen.add(key)
            want.append(number)
    for parts in (1, 7):
        once = dedup.drop_duplicate_texts(rows.repartition(parts), "id")
        assert sorted(r["id"] for r in once.collect()) == want
    assert "LeftSemi" in once._jdf.queryExecution().optimizedPlan().toString()
    again = dedup.drop_duplicate_texts(once, "id")
    assert sorted(r["id"] for r in again.collect()) == want
