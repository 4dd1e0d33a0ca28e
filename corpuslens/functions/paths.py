"""File names, paths and URLs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Extensions of files that are not source text.
BLOCKED_EXTENSIONS = [
    "3gp", "aac", "aif", "aiff", "amr", "app", "au", "avi", "bin", "bmp", "bz2", "class",
    "csv", "dat", "db", "dll", "dng", "dylib", "egg", "eot", "exe", "flac", "flv", "gif",
    "gitignore", "glif", "gradle", "gz", "heic", "heif", "ico", "jar", "jpeg", "jpg", "lo",
    "lock", "log", "m4a", "m4v", "mid", "midi", "mkv", "mov", "mp3", "mp4", "mpeg", "mpg",
    "nar", "o", "ogg", "ogv", "opus", "otf", "p", "pdf", "pickle", "pkl", "png", "pyc",
    "pyd", "pyo", "ra", "ram", "rkt", "rm", "so", "ss", "svg", "t3", "tar", "tif", "tiff",
    "ts", "tsv", "ttf", "war", "wav", "webm", "webp", "wmv", "woff", "woff2", "xz", "zip",
    "zst",
]

# Substrings that rule a file name out.
BLOCKED_NAME_PARTS = [".git", "LICENSE", "node_modules", ".min."]


def decoded_file_path(path: Column) -> Column:
    """File path without the percent escapes of ``_metadata.file_path``."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def parent_name(path: Column) -> Column:
    """Name of the directory a file lies in: the language in a corpus tree."""
    return F.element_at(F.split(path, "/"), -2)


def last_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def plan_downloads(urls: DataFrame, root: str, url: str = "url") -> DataFrame:
    """Where each URL of a manifest lands: ``<root>/<language>/<file>``."""
    lang, name = parent_name(F.col(url)), last_name(F.col(url))
    return urls.select(
        F.col(url),
        lang.alias("lang"),
        name.alias("file_name"),
        F.concat_ws("/", F.lit(root.rstrip("/")), lang, name).alias("target_path"),
    )


def extension(name: Column) -> Column:
    """Text after the last dot, or the whole name where there is none."""
    return F.substring_index(name, ".", -1)


def relative_name(path: Column, root: Column) -> Column:
    """``path`` without the leading ``root`` directory."""
    return F.when(
        F.startswith(path, F.concat(root, F.lit("/"))),
        F.substr(path, F.length(root) + 2),
    ).otherwise(path)


def blocked_extensions(additional: list[str] | None = None) -> list[str]:
    return BLOCKED_EXTENSIONS + list(additional or [])


def has_valid_name(
    name: Column, additional_extensions: list[str] | None = None, match_on: str = "name"
) -> Column:
    """Name rules a file must pass to be read at all.

    ``match_on="name"`` looks at the base name only, so files inside a ``node_modules``
    folder pass; ``match_on="path"`` applies the substring rules to the whole path.
    """
    if match_on not in ("name", "path"):
        raise ValueError("match_on must be 'name' or 'path'")
    base = last_name(name)
    searched = base if match_on == "name" else name
    valid = ~F.startswith(base, F.lit("."))
    for part in BLOCKED_NAME_PARTS:
        valid = valid & ~F.contains(searched, F.lit(part))
    return valid & ~extension(base).isin(blocked_extensions(additional_extensions))
