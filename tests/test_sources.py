import gzip
import json
import re
from pathlib import Path

import pytest
from corpuslens import schemas
from corpuslens.functions import decoding
from corpuslens.functions.text import byte_size
from corpuslens.operators import reports, rules
from corpuslens.plans.curate import LanguageChoice, curate, curate_with_funnel, label_corpus, selected_files
from corpuslens.plans.extract import extract, extract_landed, outcomes, success_report
from corpuslens.operators import positions
from corpuslens.sources import readers, writers
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLIM_COLUMNS = schemas.SLIM.names


def full_row(n, lang, content="x = 1\n", **change):
    row = {"content": content, "max_stars_repo_name": f"o/r{n}", "ext": "py", "lang": lang,
           "size": 2000, "max_line_length": 80, "avg_line_length": 30.0, "alphanum_fraction": 0.7}
    row |= change
    return tuple(row.get(f.name) for f in schemas.FULL.fields)


# Directory names that need escaping in a URL. Directories that start with a dot are not seen.
LANGS = {"python": "Python", "c++": "C++", "c#": "C#", "visual basic": "Visual Basic", "csv": "CSV"}
HIDDEN = {".csv": "CSV"}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Two files per language, eight rows each; one language has ten more rows."""
    root = tmp_path_factory.mktemp("corpus")
    for directory, lang in (LANGS | HIDDEN).items():
        for part in range(2):
            rows = [full_row(n, lang) for n in range(2)]
            rows.append(full_row(2, lang, max_line_length=5000))
            rows.append(full_row(3, lang, size=10))
            rows.append(full_row(4, lang, content="print 'x'"))
            rows.append(full_row(5, lang, avg_line_length=None))
            rows.append(full_row(6, lang, alphanum_fraction=1.0))
            rows.append(full_row(7, lang, size=60, avg_line_length=50.0))
            if directory == "c++":
                rows += [full_row(n, lang) for n in range(8, 18)]
            frame = spark.createDataFrame(rows, schemas.FULL).coalesce(1)
            target = root / directory / f"data-{part}.parquet"
            target.parent.mkdir(exist_ok=True)
            scratch = root.parent / f"scratch-{directory}-{part}"
            frame.write.parquet(str(scratch))
            target.write_bytes(next(scratch.glob("*.parquet")).read_bytes())
    return str(root)


def test_full_scan_reads_eight_columns(spark, corpus):
    rows = readers.scan_corpus(spark, corpus)
    assert rows.schema == schemas.SLIM
    assert rows.count() == 5 * 16 + 20
    plan = rows._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"FileScan parquet \[(.*?)\]", plan).group(1)
    assert {c.split("#")[0] for c in read.split(",")} == set(schemas.SLIM_FROM_FULL.values())
    narrow = rows.select("file_size")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<size:bigint>" in narrow


def test_slim_scan(spark, corpus, tmp_path):
    path = str(tmp_path / "slim")
    readers.scan_corpus(spark, corpus).write.parquet(path)
    again = readers.scan_corpus(spark, path, is_slim=True)
    assert again.columns == SLIM_COLUMNS and again.count() == 100


def test_slim_scan_of_other_types(spark, corpus, tmp_path):
    path = str(tmp_path / "wide")
    wide = readers.scan_corpus(spark, corpus).withColumn("ave_ll", F.col("ave_ll").cast("double"))
    wide = wide.withColumn("extra", F.lit("x"))
    wide.write.parquet(path)
    rows = readers.scan_corpus(spark, path, is_slim=True, schema=wide.schema)
    assert rows.columns == [*SLIM_COLUMNS, "extra"]
    labels = rules.cascade(rows, rules.tier("moderate"), "off").groupBy("reason").count()
    again = rules.cascade(readers.scan_corpus(spark, corpus), rules.tier("moderate"), "off")
    assert set(labels.collect()) == set(again.groupBy("reason").count().collect())


def test_full_schema():
    assert len(schemas.FULL.names) == len(set(schemas.FULL.names)) == 32
    lists = schemas.full(T.ArrayType(T.StringType()))
    assert lists.names == schemas.FULL.names
    assert isinstance(lists["max_forks_repo_licenses"].dataType, T.ArrayType)


def test_missing_path(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.scan_corpus(spark, str(tmp_path / "nowhere"))


def test_listing(spark, corpus):
    files = readers.list_corpus(spark, corpus)
    got = {(r["lang"], r["pq_path"].rsplit("/", 1)[-1]): r["length"] for r in files.collect()}
    want = {(p.parent.name, p.name): p.stat().st_size for p in Path(corpus).rglob("*.parquet")}
    want = {key: size for key, size in want.items() if key[0] not in HIDDEN}
    assert got == want and len(got) == 10
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    total = readers.list_files(spark, corpus).agg(byte_size(F.sum("length"), "KB")).first()[0]
    assert total == sum(want.values()) / 1024


def test_tree_scan_knows_the_origin(spark, corpus):
    rows = readers.scan_corpus_tree(spark, corpus)
    got = {(r["lang"], r["repo_lang"]) for r in rows.select("lang", "repo_lang").distinct().collect()}
    assert got == set(LANGS.items())
    assert {r[0].rsplit("/", 2)[1] for r in rows.select("src_path").distinct().collect()} == set(LANGS)
    ordered = writers.in_original_order(rows.filter("lang = 'c#'")).collect()
    assert [r["src_row"] for r in ordered] == list(range(8)) * 2


REASONS = [None, None, "max_ll", "file_too_small", None, "ave_ll", "alphanum_frac", "min_lines"]


def test_label_corpus(spark, corpus):
    out = label_corpus(spark, corpus, "Moderate", LanguageChoice(bad_langs=("csv", "other")))
    assert {r[0] for r in out.select("lang").distinct().collect()} == set(LANGS) - {"csv"}
    for lang in ("python", "visual basic"):
        rows = writers.in_original_order(out.filter(F.col("lang") == lang)).collect()
        want = list(REASONS)
        if lang == "python":
            want[4] = "python2"
        assert [r["reason"] for r in rows] == want * 2


@pytest.mark.parametrize("rebalance", [False, True])
def test_curate(spark, corpus, tmp_path, rebalance):
    out = str(tmp_path / "out")
    files = curate(
        spark, corpus, out, "moderate", LanguageChoice(bad_langs=("csv",)), python_gate="all", rebalance=rebalance
    )
    rows = spark.read.parquet(f"{out}/rows")
    assert rows.count() == 16 * 4 + 20
    counts = {(r["lang"], r["verdict"]): r["count"] for r in rows.groupBy("lang", "verdict").count().collect()}
    assert counts[("python", "kept")] == 4 and counts[("c++", "kept")] == 24
    assert counts[("c#", "rejected")] == 12
    pruned = writers.read_kept(rows)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(verdict" in pruned
    assert rows.filter("verdict = 'kept' and reason is not null").count() == 0
    assert rows.filter("verdict = 'rejected' and reason is null").count() == 0
    # original order inside each output file
    place = [F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")]
    order = rows.select(*place, "src_path", "src_row")
    by_file = {}
    for r in order.orderBy("f", "i").collect():
        by_file.setdefault(r["f"], []).append((r["src_path"], r["src_row"]))
    assert all(v == sorted(v) for v in by_file.values())
    table = {r["pq_path"]: r for r in files.collect()}
    assert len(table) == 8
    for path, row in table.items():
        assert row["lang"] == path.rsplit("/", 2)[1]
        assert Path(row["filtered_pq_path"]).is_dir()
        assert row["lang_file_cnt"] == 2 and row["lang_size_mb"] > 0
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        curate(spark, corpus, out)


def test_own_thresholds_without_origin(spark, corpus, tmp_path):
    out, strict = str(tmp_path / "out"), rules.Thresholds(min_len=2001)
    curate(spark, corpus, out, strict, LanguageChoice(bad_langs=("c++",)), keep_origin=False)
    rows = spark.read.parquet(f"{out}/rows")
    assert set(rows.columns) == {*SLIM_COLUMNS, "reason", "verdict", "lang"}
    assert rows.count() == 64
    reasons = {r["reason"] for r in rows.select("reason").distinct().collect()}
    assert reasons == {"max_ll", "file_too_small"}
    place = [F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")]
    by_file = {}
    for r in rows.select(*place, "repo_name").orderBy("f", "i").collect():
        by_file.setdefault(r["f"], []).append(r["repo_name"])
    # each input file holds the repositories in ascending order
    for names in by_file.values():
        descents = sum(a > b for a, b in zip(names, names[1:]))
        assert descents <= 1


def test_curate_reads_the_corpus_once(spark, corpus):
    plan = label_corpus(spark, corpus)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan


def test_gate_by_directory_reads_every_directory_once(spark, corpus):
    def plan(**choice):
        rows = label_corpus(spark, corpus, choice=LanguageChoice(**choice), python_gate="python_directories")
        return rows._jdf.queryExecution().executedPlan().toString()

    # the directory of Python alone passes the evaluator, in a scan of its own
    split = plan()
    assert split.count("Scan parquet") == 2 and "Exchange" not in split
    assert split.count("ArrowEvalPython") == 1
    parsed, rest = split[: split.rindex("Scan parquet")], split[split.rindex("Scan parquet") :]
    assert "/python]" in parsed and "ArrowEvalPython" in parsed and "/python]" not in rest
    without = plan(bad_langs=("python",))
    assert without.count("Scan parquet") == 1 and "ArrowEvalPython" not in without


def test_gate_by_directory(spark, tmp_path):
    whole = {f.name: None for f in schemas.SLIM.fields}
    row = {**whole, "file_size": 900, "max_ll": 90, "ave_ll": 30.0, "alphanum_frac": 0.6, "content": "print 'x'"}
    for folder, label in (("Python", None), ("go", "Python"), ("go/python", "go")):
        row["repo_lang"] = label
        rows = spark.createDataFrame([tuple(row.values())], schemas.SLIM)
        rows.write.parquet(str(tmp_path / folder), mode="append")
    out = label_corpus(spark, str(tmp_path), choice=LanguageChoice(bad_langs=()), is_slim=True, python_gate="python_directories")
    got = sorted((r["lang"], r["reason"]) for r in out.select("lang", F.coalesce("reason", F.lit("")).alias("reason")).collect())
    # the label of a row plays no part
    assert got == [("Python", "python2"), ("go", ""), ("python", "python2")]


def test_gate_by_directory_agrees_where_labels_do(spark, corpus, tmp_path):
    by_row = label_corpus(spark, corpus, "moderate")
    _, funnel = curate_with_funnel(spark, corpus, str(tmp_path / "out"), "moderate", python_gate="python_directories")
    want = reports.funnel(by_row, syntax_gate=True)
    assert sorted(map(tuple, funnel.collect())) == sorted(map(tuple, want.collect()))
    rows = label_corpus(spark, corpus, "moderate", python_gate="python_directories")
    assert rows.exceptAll(by_row).count() == by_row.exceptAll(rows).count() == 0
    nothing = label_corpus(spark, corpus, choice=LanguageChoice(mb_size_thresh=1e9), python_gate="python_directories")
    assert nothing.count() == 0 and nothing.columns == rows.columns


def test_language_choice(spark, corpus):
    assert selected_files(spark, corpus, LanguageChoice(top_k=1)).select("lang").distinct().count() == 1
    chosen = label_corpus(spark, corpus, choice=LanguageChoice(top_k=1))
    sizes = {}
    for path in Path(corpus).glob("[!.]*/*.parquet"):
        sizes[path.parent.name] = sizes.get(path.parent.name, 0) + path.stat().st_size
    largest = min(sizes, key=lambda lang: (-sizes[lang], lang))
    assert {r[0] for r in chosen.select("lang").distinct().collect()} == {largest}
    location = chosen._jdf.queryExecution().executedPlan().toString()
    assert f"/{largest}]" in location  # the other directories are not read
    everything = label_corpus(spark, corpus, choice=LanguageChoice(bad_langs=()))
    assert everything.count() == 100
    nothing = label_corpus(spark, corpus, choice=LanguageChoice(mb_size_thresh=1e9))
    assert nothing.count() == 0 and nothing.columns == everything.columns


def test_only_chosen_directories_are_read(spark, tmp_path):
    """However many there are; the others are not even listed."""
    root = tmp_path / "many"
    rows = spark.createDataFrame([(f"l{i}",) for i in range(1005)], "lang string")
    rows = rows.withColumn("folder", F.col("lang")).repartition(8, "folder")
    columns = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "lang" else F.col("lang") for f in schemas.FULL.fields]
    rows.select(*columns, "folder").write.partitionBy("folder").parquet(str(root))
    bad = ("folder=l1", "folder=l2", "folder=l3", "folder=l4")
    out = label_corpus(spark, str(root), choice=LanguageChoice(bad_langs=bad), python_gate="off")
    assert out.count() == 1001
    assert len(out.inputFiles()) == 1001
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_nested_and_oddly_named_directories(spark, corpus, tmp_path, tmp_path_factory):
    source = next(Path(corpus).glob("python/*.parquet")).read_bytes()
    for name in ("a[b]c", "outer", "outer/inner", "x{1,2}*"):
        (tmp_path / name).mkdir(parents=True, exist_ok=True)
        (tmp_path / name / "data.parquet").write_bytes(source)
    out = label_corpus(spark, str(tmp_path))
    counts = {r["lang"]: r["count"] for r in out.groupBy("lang").count().collect()}
    assert counts == {"a[b]c": 8, "outer": 8, "inner": 8, "x{1,2}*": 8}
    out = str(tmp_path_factory.mktemp("out"))
    table = curate(spark, str(tmp_path), out).collect()
    assert len(table) == 4
    for row in table:
        kept = spark.read.parquet(row["filtered_pq_path"].replace("[", "\\[").replace("{", "\\{").replace("*", "\\*"))
        assert kept.count() == 2
    only = label_corpus(spark, str(tmp_path), choice=LanguageChoice(bad_langs=("inner",)))
    assert "inner" not in {r["lang"] for r in only.collect()}


def test_repo_list_and_urls(spark, tmp_path):
    repos = tmp_path / "repos.csv"
    repos.write_text('id,repo_name,stars\n1,o/a,5\n2,"o/b,c",6\n')
    assert [r[0] for r in readers.read_repo_list(spark, str(repos)).collect()] == ["o/a", "o/b,c"]
    urls = spark.createDataFrame([("https://h/x/1.parquet",), ("https://h/y/2.parquet?a=1,2",)], "url string")
    path = str(tmp_path / "urls")
    writers.write_url_manifest(urls, path)
    assert sorted(r[0] for r in readers.read_url_manifest(spark, path).collect()) == sorted(r[0] for r in urls.collect())
    plain = tmp_path / "plain.csv"
    plain.write_text("0\nhttps://h/z/3.parquet\n")
    assert [r["url"] for r in readers.read_url_manifest(spark, str(plain)).collect()] == ["https://h/z/3.parquet"]


def test_json_document(spark, tmp_path):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text(json.dumps({"a": 1, "b": {"c": ["x"]}}, indent=2))
    bad.write_text('{"a": 1,')
    row = readers.read_json_document(spark, str(good)).first()
    assert row["a"] == 1 and row["b"]["c"] == ["x"]
    with pytest.raises(Exception):
        readers.read_json_document(spark, str(bad), "a int").collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_json_document(spark, str(tmp_path / "none.json"))


# Landed repositories -------------------------------------------------------------------

LONG = "def f():\n    return 'long enough'\n"


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    files = {
        "ann/tool/__init__.py": LONG.encode(),
        "ann/tool/src/_private/main.py": ("# é€\n" + LONG).encode(),
        "ann/tool/latin.py": ("# café\n" + LONG).encode("latin-1"),
        "ann/tool/wide.txt": ("wide \U0001F600 " + LONG).encode("utf-16"),
        "ann/tool/data": b"\x00\x01\x02" * 50,
        "ann/tool/empty.py": b"",
        "ann/tool/tiny.py": b"x = 1",
        "ann/tool/exact.py": b"x" * 16,
        "ann/tool/picture.png": LONG.encode(),
        "ann/tool/.hidden.py": LONG.encode(),
        "ann/tool/LICENSE": LONG.encode(),
        "ann/tool/node_modules/lib.js": LONG.encode(),
        "ann/tool/.git/config.py": LONG.encode(),
        "ann/tool/with space+plus%41.py": LONG.encode(),
        "ann/tool/big.txt": b"y" * (1024 * 1024 + 1),
        "ann/tool/limit.txt": "é".encode() * (1024 * 1024),
        "bob/tool/main.py": ("# other\n" + LONG).encode(),
    }
    for name, data in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    (root / "ann/tool/broken.py").symlink_to(root / "nothing")
    return str(root)


@pytest.fixture(scope="module")
def repos(spark):
    return spark.createDataFrame([("ann/tool",), ("bob/tool",), ("eve/absent",)], schemas.REPO_LIST)


WANTED = {
    "ann/tool": {
        "__init__.py", "src/_private/main.py", "latin.py", "wide.txt", "exact.py",
        "node_modules/lib.js", "with space+plus%41.py", "limit.txt",
    },
    "bob/tool": {"main.py"},
}


def test_extract(spark, tree, repos):
    rows = extract(repos, tree).collect()
    got = {}
    for r in rows:
        got.setdefault(r["meta"]["repo_name"], set()).add(r["meta"]["file_name"])
        assert r["meta"]["mime_type"] == "text/plain"
    assert got == WANTED
    texts = {r["meta"]["file_name"]: r["text"] for r in rows if r["meta"]["repo_name"] == "ann/tool"}
    assert texts["latin.py"] == "# café\n" + LONG
    assert texts["wide.txt"] == "wide \U0001F600 " + LONG
    assert len(texts["limit.txt"]) == 1024 * 1024
    by_path = extract(repos, tree, match_on="path", additional_extensions=["txt"], fallback=None)
    names = {r["meta"]["file_name"] for r in by_path.collect()}
    assert names == (WANTED["ann/tool"] | {"main.py"}) - {"node_modules/lib.js", "wide.txt", "limit.txt", "latin.py"}


def test_extract_landed(spark, tree):
    """The same files but for names that Spark's own source does not see."""
    for root in (tree, tree + "/", "file://" + tree):
        got = {}
        for r in extract_landed(spark, root).collect():
            got.setdefault(r["meta"]["repo_name"], {})[r["meta"]["file_name"]] = r["text"]
        hidden = {"__init__.py", "src/_private/main.py"}
        assert {repo: set(names) for repo, names in got.items()} == {r: w - hidden for r, w in WANTED.items()}
        assert got["ann/tool"]["latin.py"] == "# café\n" + LONG
    by_path = extract_landed(spark, tree, match_on="path", additional_extensions=["txt"], fallback=None)
    names = {r["meta"]["file_name"] for r in by_path.collect()}
    assert names == {"exact.py", "with space+plus%41.py", "main.py"}


def test_landed_scan_opens_no_file_in_vain(spark, tree):
    names = readers.scan_landed(spark, tree).filter("length between 10 and 20").select("file_name")
    plan = names._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(length,10)" in plan and "Exchange" not in plan
    assert "content" not in plan.split("ReadSchema:")[-1]
    repos = {r[0] for r in readers.scan_landed(spark, tree).select("repo_name").collect()}
    assert repos == {"ann/tool", "bob/tool"}


@pytest.fixture(scope="module")
def bushy(tmp_path_factory):
    """A folder for each file, odd names, links, and what Spark's sources do not see."""
    root = tmp_path_factory.mktemp("bushy [x]")
    names = [f"r{n % 3}/s/part{n}/d/f{n}.py" for n in range(300)]
    names += [
        "r/s/sp ace+%41.py", "r/s/é\U0001F600.py", "r/s/q?[1]{2}.py", "r/s/new\nline.py", "r/s/_k=v.py",
        "r/s/_metadata_x/f.py", "_o=1/s/f.py", "top.py", "r/mid.py", "r/s/_f.py", "r/s/.h", "r/s/_metadata",
        "r/s/x._COPYING_", "r/s/y._COPYING_/z.py", "r/s/.git/c.py", "_o/s/f.py", "r/.s/f.py", "r/s/c/d/e.py",
    ]
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"0123456789 0123456789 " + name.encode())
    (root / "r/s/empty.py").write_bytes(b"")
    (root / "r/s/gone.py").symlink_to(root / "nothing")
    (root / "r/s/file.py").symlink_to(root / "r/s/c/d/e.py")
    (root / "r/s/folder").symlink_to(root / "r/s/c")
    return str(root)


def test_landed_scan_sees_what_the_file_source_sees(spark, bushy):
    literal = bushy.replace("[", "\\[").replace("]", "\\]")
    source = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(literal)
    depth = F.size(F.split(F.substr("path", F.lit(len(f"file:{bushy}/") + 1)), "/"))
    want = sorted(map(tuple, source.filter(depth > 2).select("path", "length", "content").collect()))
    for root in (bushy, bushy + "/", "file:" + bushy, "file://" + bushy):
        rows = readers.scan_landed(spark, root)
        assert sorted(map(tuple, rows.select("file_path", "length", "content").collect())) == want
    named = F.concat(F.lit(f"file:{bushy}/"), "repo_name", F.lit("/"), "file_name") == F.col("file_path")
    assert len(want) == 310 and rows.filter(~named).count() == 0
    with pytest.raises(Exception, match="No such file"):
        readers.scan_landed(spark, bushy + "/absent").count()


def test_tasks_list_a_landed_tree(spark, bushy):
    """Neither the driver's index nor the tasks of the scan grow with the files."""
    rows = readers.scan_landed(spark, bushy)
    assert "parquet" in rows._jdf.queryExecution().executedPlan().toString()
    assert not any(path.endswith(".py") for path in rows.inputFiles())
    assert rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_landed_files_are_read_by_few_tasks(spark, bushy, tmp_path):
    rows = extract_landed(spark, bushy)
    assert rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert rows.count() == 310
    path = tmp_path / "a/b/c.py"
    path.parent.mkdir(parents=True)
    path.write_text(LONG)
    rows = extract_landed(spark, str(tmp_path))
    path.unlink()
    with pytest.raises(Exception, match="No such file"):
        rows.collect()
    with pytest.raises(ValueError):
        readers.read_contents(readers.list_landed(spark, bushy), missing="skip")


def test_long_text_in_four_bytes_a_character(spark, tmp_path):
    path = tmp_path / "a/b/c.txt"
    path.parent.mkdir(parents=True)
    path.write_bytes(b"\x00\x00\xfe\xff" + ("x" * 1024 * 1024).encode("utf-32-be"))
    repos = spark.createDataFrame([("a/b",)], schemas.REPO_LIST)
    for rows in (extract(repos, str(tmp_path)), extract_landed(spark, str(tmp_path))):
        assert [len(r["text"]) for r in rows.collect()] == [1024 * 1024]


def test_remote_style_path(spark, tree, repos):
    names = {r["file_name"] for r in readers.list_repositories(repos, "file://" + tree).collect()}
    assert "__init__.py" in names and "src/_private/main.py" in names and ".git/config.py" not in names
    got = {}
    for r in extract(repos, "file://" + tree).collect():
        got.setdefault(r["meta"]["repo_name"], set()).add(r["meta"]["file_name"])
    assert got == WANTED
    listed = readers.list_repositories(repos, "file://" + tree).filter("file_name = 'main.py'")
    assert readers.read_contents(listed).first()["content"].startswith(b"# other")


def test_vanished_file(spark, tree, repos):
    listed = readers.list_repositories(repos, tree).filter("repo_name = 'bob/tool'")
    gone = listed.withColumn("file_path", F.concat("file_path", F.lit(".gone")))
    rows = readers.read_contents(gone).select("content", decoding.mime_type(F.col("content"))).collect()
    assert [tuple(r) for r in rows] == [(None, "n/a")]


def test_archive_round_trip(spark, tree, repos, tmp_path):
    path = tmp_path / "archive"
    rows = extract(repos, tree)
    writers.write_archive(rows, str(path))
    parts = list(path.glob("*.json.gz"))
    first = json.loads(gzip.open(parts[0], "rt", encoding="utf-8").readline())
    assert set(first) == {"text", "meta"}
    again = readers.read_archive(spark, str(path))
    assert again.schema == schemas.ARCHIVE
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows.collect()))


def test_success_report(spark, tree, repos):
    listed = positions.with_row_index(repos, ["repo_name"]).drop("_total")
    listed = listed.withColumn("failed", F.col("repo_name") == "eve/absent")
    results = outcomes(listed, extract(repos, tree), 2)
    counts = {r["repo_name"]: (r["chunk_id"], r["n_files"]) for r in results.collect()}
    assert counts == {"ann/tool": (0, 8), "bob/tool": (0, 1), "eve/absent": (1, 0)}
    report = {tuple(r) for r in success_report(results).collect()}
    assert report == {(0, 100.0, 100.0), (1, 0.0, 50.0)}


BYTES = [
    b"plain", "é€".encode(), b"caf\xe9", b"", "wide".encode("utf-16"), "w\U0001F600".encode("utf-16-be"),
    b"\xfe\xff" + "w\U0001F600".encode("utf-16-be"), b"\xff\xfe" + b"\x00\xd8" + b"a\x00", b"\xff\xfeabc",
    b"a\x00b", None, b"\xef\xbb\xbfbom",
]


def test_decoding(spark):
    rows = spark.createDataFrame([(n, b) for n, b in enumerate(BYTES)], "id int, content binary")
    body = F.col("content")
    got = rows.orderBy("id").select(
        decoding.decode_text(body), decoding.decode_text(body, None), decoding.is_text(body),
        decoding.mime_type(body),
    ).collect()
    for data, (text, strict, is_text, mime) in zip(BYTES, got, strict=True):
        if data is None:
            assert (text, is_text, mime) == (None, False, "n/a")
            continue
        want = None
        for charset in ("utf-8", "utf-16"):
            if charset == "utf-16" and data[:2] not in (b"\xff\xfe", b"\xfe\xff"):
                continue
            try:
                want = data.decode(charset)
                break
            except UnicodeDecodeError:
                pass
        assert strict == want
        assert text == (data.decode("latin-1") if want is None else want)
        utf16 = want is not None and data[:2] in (b"\xff\xfe", b"\xfe\xff")
        assert is_text == (bool(data) and (b"\x00" not in data or utf16))
        assert mime == ("text/plain" if is_text else "application/octet-stream")
    with pytest.raises(ValueError):
        decoding.decode_text(body, "Shift_JIS")


def test_rules_run_on_a_stream_unchanged(spark, corpus, tmp_path):
    """The operators hold no state, so a streaming read can use them as they are."""
    path = str(tmp_path / "slim")
    readers.scan_corpus(spark, corpus).write.parquet(path)
    stream = spark.readStream.schema(schemas.SLIM).parquet(path)
    out = rules.cascade(stream, rules.tier("moderate"))
    run = out.writeStream.format("memory").queryName("labelled").trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert spark.table("labelled").filter("verdict = 'kept'").count() == 48


def test_curated_output_reads_back_with_declared_types(spark, tmp_path):
    schema = T.StructType(schemas.SLIM.fields + T.StructType.fromDDL("src_path string, src_row bigint, lang string").fields)
    row = ("o/r", "py", "x", 100, 40, 20.0, 0.5, "c", "a", 0)
    rows = spark.createDataFrame([(*row, "02"), (*row, "1")], schema)
    for name, part in (("some", rows), ("none", rows.limit(0))):
        path = str(tmp_path / name)
        writers.write_curated(rules.cascade(part, rules.tier("moderate"), "off"), path)
        back = writers.read_curated(spark, path)
        assert sorted(r["lang"] for r in back.collect()) == (["02", "1"] if name == "some" else [])


def test_tree_without_parquet_files_is_an_error(spark, tmp_path):
    root = tmp_path / "x[1]"
    root.mkdir()
    (root / "note.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        selected_files(spark, str(root))


def test_listing_is_planned_by_files_and_skips_links(spark, tmp_path):
    """16 files larger than a split are listed by one task; the caller's settings stay."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        (tmp_path / "tree" / "sub dir").mkdir(parents=True)
        for i in range(16):
            (tmp_path / "tree" / "sub dir" / f"f{i}%41.bin").write_bytes(b"x" * (5000 + i))
        (tmp_path / "tree" / "link.bin").symlink_to(tmp_path / "tree" / "sub dir" / "f1%41.bin")
        found = readers.list_files(spark, str(tmp_path / "tree"))
        assert sorted(r["length"] for r in found.collect()) == list(range(5000, 5016))
        assert spark.conf.get(key) == "1000"
        stored = [f for f in found.inputFiles() if f.endswith(".parquet")]
        assert len(stored) <= 4  # one file for each task that listed
    finally:
        spark.conf.set(key, before)


def test_json_documents_of_any_shape(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"n": 1, "tags": ["x"],\n "who": {"name": "é"}}')
    (tmp_path / "b.json").write_text('{"n": 2.5, "more": null, "who": {"age": 3}}')
    found = readers.read_json_documents(spark, str(tmp_path))
    rows = {r["path"].rsplit("/", 1)[-1]: r for r in readers.typed_documents(found).collect()}
    assert rows["a.json"]["n"] == 1 and float(rows["b.json"]["n"]) == 2.5
    assert rows["a.json"]["who"]["name"] == "é" and rows["b.json"]["who"]["age"] == 3
    assert rows["a.json"]["tags"] == ["x"] and rows["b.json"]["tags"] is None
    who = readers.typed_documents(found, path="$.who").select("name", "age").collect()
    assert sorted(map(str, who)) == ["Row(name='é', age=None)", "Row(name=None, age=3)"]
    numbers = readers.typed_documents(found, "double", "$.n").select("value").collect()
    assert sorted(r[0] for r in numbers) == [1.0, 2.5]


def test_malformed_json_document_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"n": 1')
    with pytest.raises(Exception):
        readers.read_json_documents(spark, str(tmp_path)).collect()


def archive_source(spark, n, seen=None, fail_at=None):
    def rows_of(first, last):
        if seen is not None:
            seen.append((first, last))
        if fail_at is not None and first >= fail_at:
            raise RuntimeError("stopped")
        meta = F.struct(F.lit("r").alias("repo_name"), F.lit("f").alias("file_name"), F.lit("m").alias("mime_type"))
        ids = spark.range(n).filter(F.floor(F.col("id") / 10).between(first, last) & (F.col("id") < 70))
        return ids.select(F.concat(F.lit("text "), "id").alias("text"), meta.alias("meta"))

    return rows_of


def archived(spark, path):
    return sorted(r["text"] for r in readers.read_archive(spark, path).collect())


def test_a_stopped_archive_goes_on(spark, tmp_path):
    """Ten chunks, three to a commit; the last one is short, and one has no rows."""
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    done = writers.write_archive_at_intervals(spark, archive_source(spark, 100), 10, whole, commit_every=3)
    figures = [(0, 0, 2, 30), (1, 3, 5, 30), (2, 6, 8, 10), (3, 9, 9, 0)]
    assert sorted(map(tuple, done.collect())) == figures
    with pytest.raises(RuntimeError):
        writers.write_archive_at_intervals(spark, archive_source(spark, 100, fail_at=6), 10, parts, commit_every=3)
    assert len(archived(spark, parts)) == 60
    seen = []
    done = writers.write_archive_at_intervals(spark, archive_source(spark, 100, seen), 10, parts, commit_every=3)
    assert seen == [(6, 8), (9, 9)]
    assert sorted(map(tuple, done.collect())) == figures
    assert archived(spark, parts) == archived(spark, whole) == sorted(f"text {i}" for i in range(70))
    assert readers.read_archive(spark, parts).columns == ["text", "meta"]


def test_a_range_written_without_its_mark_replaces_itself(spark, tmp_path):
    path = tmp_path / "a"
    writers.write_archive_at_intervals(spark, archive_source(spark, 100), 10, str(path), commit_every=5)
    before = archived(spark, str(path))
    import shutil

    shutil.rmtree(path / "_commits" / "commit=1")  # the job was lost between rows and mark
    seen = []
    writers.write_archive_at_intervals(spark, archive_source(spark, 100, seen), 10, str(path), commit_every=5)
    assert seen == [(5, 9)] and archived(spark, str(path)) == before


def test_other_intervals_are_refused(spark, tmp_path):
    path = str(tmp_path / "a")
    writers.write_archive_at_intervals(spark, archive_source(spark, 100), 4, path, commit_every=2)
    with pytest.raises(ValueError):
        writers.write_archive_at_intervals(spark, archive_source(spark, 100), 4, path, commit_every=3)
    with pytest.raises(ValueError):
        writers.write_archive_at_intervals(spark, archive_source(spark, 100), 4, path, commit_every=0)


def test_the_archive_grows_with_its_list(spark, tmp_path):
    """More chunks than before: the last range, which was short, is written again."""
    path = str(tmp_path / "a")
    writers.write_archive_at_intervals(spark, archive_source(spark, 100), 3, path, commit_every=2)
    seen = []
    writers.write_archive_at_intervals(spark, archive_source(spark, 100, seen), 5, path, commit_every=2)
    assert seen == [(2, 3), (4, 4)]
    assert archived(spark, path) == sorted(f"text {i}" for i in range(50))


def test_curation_reports_its_funnel(spark, corpus, tmp_path):
    files, funnel = curate_with_funnel(spark, corpus, str(tmp_path / "out"), "moderate", python_gate="all")
    labelled = label_corpus(spark, corpus, "moderate", python_gate="all")
    want = reports.funnel(labelled, syntax_gate=True)
    assert funnel.schema == want.schema
    assert sorted(map(tuple, funnel.collect())) == sorted(map(tuple, want.collect()))
    kept = writers.read_kept(spark.read.parquet(str(tmp_path / "out" / "rows"))).count()
    assert min(r["rows_left"] for r in funnel.collect()) == kept
    watched, _ = reports.observed(labelled, syntax_gate=True)
    plan = watched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "CollectMetrics" in plan and "Exchange" not in plan


def test_funnel_of_nothing(spark, corpus, tmp_path):
    choice = LanguageChoice(mb_size_thresh=1e9)
    _, funnel = curate_with_funnel(spark, corpus, str(tmp_path / "out"), choice=choice, python_gate="off")
    assert {r["rows_left"] for r in funnel.collect()} == {0} and funnel.count() == 7
