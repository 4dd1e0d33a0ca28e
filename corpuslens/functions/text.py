"""Text functions as column expressions.

Line and whitespace rules are those of Python's ``str.splitlines`` and of ``\\s`` in a
Python pattern. Both are wider than the Java defaults, so the classes are spelled out.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# \v covers LF, VT, FF, CR, NEL and the Unicode line and paragraph separators; Python also
# breaks lines at the information separators FS, GS and RS. CRLF is made one break before.
LINE_BREAK = r"[\v\x1c-\x1e]"

# All Unicode white space plus FS, GS, RS and US, which Python counts as white space.
WHITESPACE = r"(?U)[\s\x1c-\x1f]"

ALPHANUMERIC = r"[\p{L}\p{N}]+"

TEXT_STATS = ("size", "max_line_length", "avg_line_length", "alphanum_fraction")
LINE_STATS = {"max_line_length", "avg_line_length"}

_UNITS = {"B": 1, "KB": 1024, "MB": 1024**2, "GB": 1024**3}


def line_lengths(text: Column) -> Column:
    """Length in characters of every piece between line breaks.

    A trailing line break leaves one empty piece at the end which is not a line.
    """
    return F.transform(F.split(_unified(text), LINE_BREAK), lambda piece: F.length(piece))


def _unified(text: Column) -> Column:
    """The text with every line break one character long."""
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def max_line_length(text: Column) -> Column:
    """Longest line in characters, 0 for an empty text."""
    return F.array_max(line_lengths(text))


def alphanum_fraction(text: Column) -> Column:
    """Share of characters that are letters or numbers, 0 for an empty text.

    Removing whole runs of them and counting what is left copies less than keeping them.
    """
    kept = F.length(text) - F.length(F.regexp_replace(text, ALPHANUMERIC, ""))
    share = F.try_divide(kept.cast("double"), F.length(text).cast("double"))
    return F.when(text.isNotNull(), F.coalesce(share, F.lit(0.0)))


def settle(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns in a way that later filters use their values.

    Catalyst moves a filter below the projection it refers to and would then evaluate the
    expressions once for the filter, once per comparison, and again for the output. A filter
    on generated columns stays above the generator.
    """
    together = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.withColumn("_settled", together).select(
        *df.columns, F.inline(F.array("_settled"))
    )


def with_text_stats(
    df: DataFrame, text: str = "content", only: Iterable[str] = TEXT_STATS
) -> DataFrame:
    """Add the statistics the quality rules read.

    ``size`` in UTF-8 bytes, ``max_line_length``, ``avg_line_length`` and
    ``alphanum_fraction``, or ``only`` some of them: what is not asked for is not computed.
    The text is split into lines once; what is kept of them is a narrow integer array.
    Columns that have these names already are replaced.
    """
    only = list(only)
    df = df.drop(*(name for name in only if name != text))
    body, lengths = F.col(text), F.col("_line_lengths")
    pieces = F.size(lengths)
    lines = pieces - F.when(F.element_at(lengths, -1) == 0, 1).otherwise(0)
    chars_in_lines = F.length(_unified(body)) - (pieces - 1)
    average = F.try_divide(chars_in_lines.cast("double"), lines.cast("double"))
    stats = {
        "size": F.octet_length(body).cast("bigint"),
        "max_line_length": F.array_max(lengths).cast("bigint"),
        "avg_line_length": F.when(body.isNotNull(), F.coalesce(average, F.lit(0.0))),
        "alphanum_fraction": alphanum_fraction(body),
    }
    wanted = {name: stats[name] for name in only}
    if not LINE_STATS & set(wanted):
        return settle(df, wanted)
    measured = df.withColumn("_line_lengths", line_lengths(body))
    return settle(measured, wanted).drop("_line_lengths")


def text_size(length: Column, unit: str = "MB") -> Column:
    """Characters as KB, MB or GB, one character counted as one byte.

    The unit is case-sensitive; any other unit gives the plain length.
    """
    factor = {"KB": 1024, "MB": 1024**2, "GB": 1024**3}.get(unit)
    return length / F.lit(float(factor)) if factor else length


def byte_size(total: Column, unit: str = "MB") -> Column:
    """Bytes as B, KB, MB or GB; the unit is checked before any plan is built."""
    factor = _UNITS.get(unit.upper())
    if factor is None:
        raise ValueError(f"unknown unit {unit!r}, use one of {', '.join(_UNITS)}")
    return total if factor == 1 else total / F.lit(float(factor))


def remove_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, WHITESPACE, "")


def replace_byte_strings(
    text: Column, min_length: int = 100, token: str = "<BYTE_ENCODED_STRING>"
) -> Column:
    """Replace ``b'...'`` runs of at least ``min_length`` non-ASCII characters."""
    literal = token.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, rf"b'([^\x00-\x7F]{{{min_length},}})'", literal)


def has_repeat(text: Column, piece: str, n: int) -> Column:
    """True where ``piece`` occurs at least ``n`` times back to back."""
    if n < 0:
        raise ValueError("n must not be negative")
    return F.contains(text, F.lit(piece * n))


def flatten_lists(nested: Column) -> Column:
    """One list out of a list of lists."""
    return F.flatten(nested)


def explode_lists(df: DataFrame, nested: str, name: str = "item") -> DataFrame:
    """One row per inner item, with its position in the flattened list."""
    others = [F.col(c) for c in df.columns if c != nested]
    return df.select(*others, F.posexplode(F.flatten(nested)).alias("pos", name))


# Length gates -------------------------------------------------------------------------


def keep_text(text: Column, max_mb: float = 1, min_chars: int = 16) -> Column:
    """At least ``min_chars`` characters and at most ``max_mb`` megabytes of them."""
    size = F.length(text)
    held = (size >= min_chars) & (size <= int(max_mb * 1024**2))
    return F.coalesce(held, F.lit(False))


def filter_max_line_length(df: DataFrame, max_length: int = 1000, text: str = "text") -> DataFrame:
    """Rows whose longest line is strictly shorter than ``max_length``."""
    return df.filter(max_line_length(F.col(text)) < max_length)


def filter_max_text_size(df: DataFrame, max_mb: float = 1, text: str = "text") -> DataFrame:
    """Rows strictly smaller than ``max_mb`` megabytes of characters."""
    return df.filter(text_size(F.length(text), "MB") < float(max_mb))
