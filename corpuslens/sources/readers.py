"""Where tables come from: parquet corpora, CSV lists, JSON archives and file trees."""

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens import schemas
from corpuslens.functions.paths import decoded_file_path, parent_name, relative_name
from corpuslens.operators.rules import slim
from corpuslens.session import materialize, scratch_path, use_checkpoint_dir

# Bytes of file content gathered before a batch is handed to Spark.
_BATCH_BYTES = 32 * 1024 * 1024

LISTING = T.StructType(
    [
        T.StructField("repo_name", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("length", T.LongType()),
    ]
)
_ORIGIN = [
    T.StructField("lang", T.StringType()),
    T.StructField("src_path", T.StringType()),
    T.StructField("src_row", T.LongType()),
]
_ENTRY = T.StructType(LISTING.fields + [T.StructField("is_folder", T.BooleanType())])
CONTENTS = T.StructType(LISTING.fields + [T.StructField("content", T.BinaryType())])


def scan_corpus(
    spark: SparkSession,
    path: str | list[str],
    is_slim: bool = False,
    on_overflow: str = "error",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Parquet files anywhere below ``path``.

    ``is_slim=True`` reads slim files as they are; otherwise full files are projected and
    downcast, and the scan reads eight columns only. ``schema`` declares files that hold
    other types or further columns.
    """
    found = _scan(spark, path, is_slim, schema)
    return found if is_slim else slim(found, on_overflow)


def scan_full(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """Full files as they are, for plans whose conditions are to reach the scan."""
    return _scan(spark, path, False, schema)


def scan_corpus_tree(
    spark: SparkSession,
    path: str | list[str],
    is_slim: bool = False,
    on_overflow: str = "error",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Like ``scan_corpus``, with where each row came from.

    ``lang`` is the directory a file lies in; ``src_path`` and ``src_row`` give the
    original order. Directories that start with a dot or an underscore are not seen.
    """
    found = _scan(spark, path, is_slim, schema)
    file_path = decoded_file_path(F.col("_metadata.file_path"))
    origin = [
        parent_name(file_path).alias("lang"),
        file_path.alias("src_path"),
        F.col("_metadata.row_index").alias("src_row"),
    ]
    return found.select("*", *origin) if is_slim else slim(found, on_overflow, origin)


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores on a scan that is planned as fewer tasks than there are cores.

    Text functions are bound by the processor, and a single small file would be read by one
    task. A scan of many splits, which is the normal case, is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def empty_corpus_tree(spark: SparkSession) -> DataFrame:
    """What ``scan_corpus_tree`` gives where no file was chosen."""
    columns = T.StructType(schemas.SLIM.fields + _ORIGIN)
    return spark.createDataFrame([], columns)


def _scan(
    spark: SparkSession, path: str | list[str], is_slim: bool, schema: T.StructType | None
) -> DataFrame:
    reader = spark.read.schema(schema or (schemas.SLIM if is_slim else schemas.FULL))
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    path = [path] if isinstance(path, str) else path
    # each directory is read with all below it, so one inside another is not named again
    paths = [p for p in path if not any(p.startswith(f"{q.rstrip('/')}/") for q in path)]
    return reader.parquet(*[_literal(p) for p in paths])


def _literal(path: str) -> str:
    """A path whose special characters are no patterns."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def list_corpus(spark: SparkSession, root: str) -> DataFrame:
    """One row per parquet file below ``root``: path, language and length in bytes.

    File contents are not read; links are left out.
    """
    path = F.col("path")
    return _listing(spark, root, "*.parquet").select(
        path.alias("pq_path"), parent_name(path).alias("lang"), "length"
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path and length of every file below ``root`` except hidden ones and links."""
    return _listing(spark, root, None)


# Files to a task of a listing, and what the planner counts a file for beside its length. Only
# lengths are read, so a task is sized by its files; 2**34 times 2**29 files still fit a number.
_LISTED_FILES = 4096
_LISTED_WEIGHT = 1 << 34


def _listing(spark: SparkSession, root: str, pattern: str | None) -> DataFrame:
    """Path and length of the files below ``root``, as a stored table; links are left out.

    The scan reads no content, but would be planned by length, one task to a large file. How a
    scan is cut is a setting of the session that plans it, so the listing is written by a session
    of its own, on the same executors, and read by the caller's.
    """
    planner = spark.newSession()
    use_checkpoint_dir(planner)
    planner.conf.set("spark.sql.files.openCostInBytes", _LISTED_WEIGHT)
    planner.conf.set("spark.sql.files.maxPartitionBytes", _LISTED_WEIGHT * _LISTED_FILES)
    planner.conf.set("spark.sql.files.minPartitionNum", 1)
    reader = planner.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.load(_literal(root)).select("path", "length")

    # Nested, so that it is shipped to the workers by value. Stores other than disks have no links.
    def no_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        import pyarrow as pa

        for batch in batches:
            paths = batch.column(0).to_pylist()
            keep = [not (p.startswith("file:") and os.path.islink(p[len("file:") :])) for p in paths]
            yield batch.filter(pa.array(keep, pa.bool_()))

    listed = scratch_path(spark, "listing")
    found.mapInArrow(no_links, found.schema).write.parquet(listed)
    return spark.read.schema(found.schema).parquet(listed)


def read_repo_list(spark: SparkSession, path: str) -> DataFrame:
    """Column ``repo_name`` of a CSV file with a header."""
    return _read_csv(spark, path).select(F.col("repo_name").cast("string"))


def read_url_manifest(spark: SparkSession, path: str) -> DataFrame:
    """First column of a CSV file with a header, whatever its name."""
    found = _read_csv(spark, path)
    return found.select(found[found.columns[0]].cast("string").alias("url"))


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    # names come from the header line; all values stay strings without inference
    return spark.read.option("header", True).option("escape", '"').csv(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines archive of extracted files, written at once or at intervals; a malformed line
    fails the job."""
    found = spark.read.schema(schemas.ARCHIVE).option("mode", "FAILFAST").json(path)
    return found.select(*schemas.ARCHIVE.names)


def read_json_document(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """One JSON document per file; malformed input fails the job."""
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document of any shape per file: ``path`` and ``document``, a variant.

    Nothing is inferred and no schema is declared; malformed input fails the job.
    """
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    found = reader.option("singleVariantColumn", "document").json(path)
    return found.select(decoded_file_path(F.col("_metadata.file_path")).alias("path"), "document")


def document_shape(documents: DataFrame) -> str:
    """Type that fits all documents, as DDL; found in one aggregation, so its size is that of
    the type and not of the documents. What is null in all of them is text."""
    shape = documents.agg(F.schema_of_variant_agg("document")).first()[0] or "VOID"
    shape = re.sub(r"(^|: |<)OBJECT(?=<)", r"\1STRUCT", shape)
    return re.sub(r"(^|: |<)VOID(?=$|[,>])", r"\1STRING", shape)


def typed_documents(documents: DataFrame, shape: str | None = None, path: str = "$") -> DataFrame:
    """``document`` as columns of the type ``shape``, by default the one that fits all.

    ``path`` names a part of every document. What a document does not have is null; a value that
    cannot be cast fails the job. A shape that is no structure gives one column ``value``.
    """
    part = documents.withColumn("document", F.variant_get("document", path, "variant"))
    value = F.variant_get("document", "$", shape or document_shape(part)).alias("value")
    typed = part.select("path", value)
    if isinstance(typed.schema["value"].dataType, T.StructType):
        return typed.select("path", "value.*")
    return typed


# Landed repository trees ----------------------------------------------------------------


def list_repositories(repos: DataFrame, root: str) -> DataFrame:
    """One row per file of every repository landed under ``<root>/<repo_name>``.

    Tasks list directories; the driver lists nothing. The top level of every repository is
    listed first and written to the checkpoint folder, then each of its directories is walked
    on its own, so a very large repository is shared by many tasks. The built-in file sources
    are not used here because they skip names that start with an underscore, such as
    ``__init__.py``. Directories called ``.git`` are left out and links to directories are not
    followed. A repository that did not land gives no rows. ``root`` is a mounted disk unless
    it starts with a scheme such as ``hdfs://``.
    """
    top = repos.select("repo_name", F.lit("").alias("folder"))
    level = materialize(_list_directories(top, root, recursive=False))
    folders = level.filter("is_folder").select("repo_name", F.col("file_name").alias("folder"))
    below = _list_directories(folders, root, recursive=True)
    return level.unionByName(below).filter("not is_folder").select(*LISTING.names)


def scan_landed(spark: SparkSession, root: str) -> DataFrame:
    """Files of the checkouts landed below the absolute path ``root``, as Spark's file source sees them.

    The first two folders below ``root`` name the repository; files above that level belong to
    none and are left out. Conditions on ``length`` reach the scan, so a file that fails them is not
    opened, and bytes that nobody asks for are not read. As in Spark's sources, empty files and names
    that begin with a full stop or an underscore are not seen; where those are wanted
    (``__init__.py``), ``list_repositories`` and ``read_contents`` find them.

    On a mounted disk the files are those of ``list_landed``. A condition on ``content`` may read a
    file once more there; ``read_contents`` reads each once. Other stores are read by Spark's own
    source, which lists in the driver.
    """
    if on_disk(spark, root):
        return list_landed(spark, root).withColumn("content", _file_content()("file_path"))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_literal(root))
    # a root may be written with or without the scheme and host that paths begin with
    store = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    base = re.sub("/+", "/", re.sub(store, "", root)).rstrip("/")
    inside = relative_name(F.regexp_replace("path", store, ""), F.lit(base))
    parts = F.split(inside, "/")
    rows = found.withColumn("_parts", parts).filter(F.size("_parts") > 2)
    return rows.select(
        F.array_join(F.slice("_parts", 1, 2), "/").alias("repo_name"),
        F.array_join(F.slice("_parts", F.lit(3), F.size("_parts")), "/").alias("file_name"),
        F.col("path").alias("file_path"),
        "length",
        "content",
    )


def on_disk(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` is on a disk that is mounted everywhere, also where no scheme says so."""
    scheme = re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", root)
    if scheme:
        return scheme[0] == "file:"
    store = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return store.startswith("file:")


def list_landed(spark: SparkSession, root: str) -> DataFrame:
    """One row per file of the checkouts landed below ``root`` on a mounted disk, as a stored table.

    The files and their paths are those of ``scan_landed``. Tasks list directories, and the driver
    lists nothing: first the two levels that name the repositories, then the top level of each
    repository, then all its directories on their own.
    """
    base = re.sub("/+", "/", re.sub("^file:(//[^/]*)?", "", root)).rstrip("/")
    found = spark.createDataFrame([("", "")], "repo_name string, folder string")
    for _ in range(2):
        level = _list_directories(found, base, recursive=False, as_source=True).filter("is_folder")
        name = F.concat_ws("/", F.expr("nullif(repo_name, '')"), "file_name").alias("repo_name")
        found = materialize(level.select(name, F.lit("").alias("folder")))
    top = materialize(_list_directories(found, base, recursive=False, as_source=True))
    folders = top.filter("is_folder").select("repo_name", F.col("file_name").alias("folder"))
    below = _list_directories(folders, base, recursive=True, as_source=True)
    files = top.unionByName(below).filter("not is_folder and length > 0")
    path = F.concat(F.lit("file:"), "file_path").alias("file_path")
    return materialize(files.select("repo_name", "file_name", path, "length"))


def _file_content() -> Callable:
    """Bytes of the file at a path that begins with ``file:``; a file that is gone fails the job."""

    # Batches are cut by their bytes, so they need not be as long as those that come in.
    def content(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import pyarrow as pa

        for batch in paths:
            read, held = [], 0
            for path in batch.to_pylist():
                with open(path.removeprefix("file:"), "rb") as handle:
                    read.append(handle.read())
                held += len(read[-1])
                if held >= _BATCH_BYTES:
                    yield pa.array(read, pa.binary())
                    read, held = [], 0
            if read:
                yield pa.array(read, pa.binary())

    return F.arrow_udf(content, T.BinaryType())


def _file_systems() -> Callable[[str], tuple[fs.FileSystem, str]]:
    """A function that finds the file system of a path with a scheme and the path inside it.

    Each worker connects to a store once. It is made here, not at module level, so that it
    is shipped to the workers by value.
    """
    known = {}

    def resolve(path):
        from pyarrow import fs

        scheme, rest = path.split("://", 1)
        host, _, inside = rest.partition("/")
        if (scheme, host) not in known:
            files, start = fs.FileSystem.from_uri(f"{scheme}://{host}/")
            known[scheme, host] = files, start.rstrip("/")
        files, start = known[scheme, host]
        return files, f"{start}/{inside}"

    return resolve


def _list_directories(
    folders: DataFrame, root: str, recursive: bool, as_source: bool = False
) -> DataFrame:
    """Entries of the directories ``<root>/<repo_name>/<folder>``, or all files below them.

    ``as_source=True`` sees what Spark's file sources see on a disk: no hidden names, and links to
    directories are followed.
    """
    base = root.rstrip("/")
    fields = _ENTRY.names
    resolve = _file_systems()

    # Nested, like all functions for workers, so that it is shipped by value.
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        import pyarrow as pa
        from pyarrow import fs

        def hidden(name, is_folder):
            """Spark's rule; it lists what begins like the metadata of a table, but reads folders only."""
            if is_folder and name.startswith(("_common_metadata", "_metadata")):
                return False
            underscored = name.startswith("_") and "=" not in name
            return underscored or name.startswith(".") or name.endswith("._COPYING_")

        def children(path):
            """Name, whether it is a directory, and length of what a directory holds."""
            if "://" in path:  # a remote store; without a scheme, a mounted disk
                files, inner = resolve(path)
                selector = fs.FileSelector(inner, allow_not_found=True)
                for info in files.get_file_info(selector):
                    if info.type in (fs.FileType.File, fs.FileType.Directory):
                        yield info.base_name, info.type == fs.FileType.Directory, info.size
            elif as_source or os.path.isdir(path):
                with os.scandir(path or "/") as entries:
                    for entry in entries:
                        if as_source and hidden(entry.name, entry.is_dir()):
                            continue
                        if entry.is_dir(follow_symlinks=as_source):
                            yield entry.name, True, None
                        elif entry.is_file():
                            yield entry.name, False, entry.stat().st_size

        def entries(repo, start):
            pending = [start]
            while pending:
                folder = pending.pop()
                prefix = f"{folder}/" if folder else ""
                for name, is_folder, length in children(f"{base}/{repo}/{folder}".rstrip("/")):
                    inside = prefix + name
                    if not is_folder:
                        yield repo, inside, f"{base}/{repo}/{inside}", length, False
                    elif name != ".git" and recursive:
                        pending.append(inside)
                    elif name != ".git":
                        yield repo, inside, f"{base}/{repo}/{inside}", None, True

        def flush(rows):
            types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(arrays, fields)

        rows = []
        for batch in batches:
            for repo, start in zip(*(column.to_pylist() for column in batch.columns)):
                for row in entries(repo, start):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield flush(rows)
                        rows = []
        if rows:
            yield flush(rows)

    # An explicit number of partitions, because adaptive execution would merge rows this
    # small into one task without knowing how much work each of them stands for.
    tasks = max(
        int(folders.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        folders.sparkSession.sparkContext.defaultParallelism,
    )
    return folders.repartition(tasks).mapInArrow(walk, _ENTRY)


def read_contents(
    listing: DataFrame, task_bytes: int = 128 * 1024 * 1024, missing: str = "null"
) -> DataFrame:
    """Add the bytes of every listed file, about ``task_bytes`` of them in each task.

    The listing is written to the checkpoint folder, since listing again costs as much as
    listing first, and its total length sets the number of tasks. Rows are spread by path,
    so a repository with very many files is read by many tasks. A file that has disappeared
    gets null, or fails the task with ``missing="error"``; any other error fails the task, which
    Spark then tries again.
    """
    if missing not in ("null", "error"):
        raise ValueError("missing must be 'null' or 'error'")
    fields = CONTENTS.names
    resolve = _file_systems()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        def content(path):
            try:
                if "://" in path:
                    files, inner = resolve(path)
                    with files.open_input_stream(inner) as handle:
                        return handle.read()
                with open(path.removeprefix("file:"), "rb") as handle:
                    return handle.read()
            except FileNotFoundError:
                if missing == "error":
                    raise
                return None

        def flush(rows):
            *texts, lengths, contents = zip(*rows)
            arrays = [pa.array(c, pa.string()) for c in texts]
            arrays += [pa.array(lengths, pa.int64()), pa.array(contents, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, fields)

        for batch in batches:
            rows, held = [], 0
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                data = content(row[2])
                rows.append((*row, data))
                held += len(data or b"")
                if held >= _BATCH_BYTES:
                    yield flush(rows)
                    rows, held = [], 0
            if rows:
                yield flush(rows)

    listing = materialize(listing.select(*LISTING.names))
    total = listing.agg(F.sum("length")).first()[0] or 0
    tasks = max(total // task_bytes + 1, listing.sparkSession.sparkContext.defaultParallelism)
    return listing.repartition(tasks, F.xxhash64("file_path")).mapInArrow(read, CONTENTS)
