"""Schemas of the tables the library reads and writes.

All of them are declared, none is inferred: inference would cost a pass over the corpus
and could change from one run to the next.
"""

from pyspark.sql import types as T


def _repo_columns(kind: str, licenses: T.DataType) -> list[T.StructField]:
    """Columns describing the repository with the most stars, forks or issues."""
    repo = f"max_{kind}_repo"
    text = [f"{repo}_path", f"{repo}_name", f"{repo}_head_hexsha"]
    dates = [f"{repo}_{kind}_{edge}_datetime" for edge in ("min", "max")]
    return (
        [T.StructField(c, T.StringType()) for c in text]
        + [T.StructField(f"{repo}_licenses", licenses), T.StructField(f"max_{kind}_count", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in dates]
    )


def full(licenses: T.DataType = T.StringType()) -> T.StructType:
    """One source file per row, text and precomputed statistics.

    ``licenses`` is the type of the license columns of the three repositories, which are
    strings or lists of strings.
    """
    columns = [
        T.StructField("content", T.StringType()),
        T.StructField("repository_name", T.StringType()),
        T.StructField("licenses", T.ArrayType(T.StringType())),
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("lang", T.StringType()),
        T.StructField("ext", T.StringType()),
        T.StructField("avg_line_length", T.DoubleType()),
        T.StructField("max_line_length", T.LongType()),
        T.StructField("alphanum_fraction", T.DoubleType()),
        T.StructField("hexsha", T.StringType()),
    ]
    for kind in ("stars", "forks", "issues"):
        columns += _repo_columns(kind, licenses)
    return T.StructType(columns)


FULL = full()

# The eight columns curation works on, in 32-bit types.
SLIM = T.StructType(
    [
        T.StructField("repo_name", T.StringType()),
        T.StructField("file_ext", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("file_size", T.IntegerType()),
        T.StructField("max_ll", T.IntegerType()),
        T.StructField("ave_ll", T.FloatType()),
        T.StructField("alphanum_frac", T.FloatType()),
        T.StructField("repo_lang", T.StringType()),
    ]
)

# Where each slim column comes from in the full corpus.
SLIM_FROM_FULL = {
    "repo_name": "max_stars_repo_name",
    "file_ext": "ext",
    "content": "content",
    "file_size": "size",
    "max_ll": "max_line_length",
    "ave_ll": "avg_line_length",
    "alphanum_frac": "alphanum_fraction",
    "repo_lang": "lang",
}

# JSON-lines archive of extracted files.
ARCHIVE_META = T.StructType(
    [
        T.StructField("repo_name", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("mime_type", T.StringType()),
    ]
)
ARCHIVE = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("meta", ARCHIVE_META)]
)

REPO_LIST = T.StructType([T.StructField("repo_name", T.StringType())])
URL_LIST = T.StructType([T.StructField("url", T.StringType())])
