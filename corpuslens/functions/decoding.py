"""Bytes to text, as column expressions.

Order of attempts: UTF-8; UTF-32 or UTF-16 where a byte order mark says so; then one declared
single-byte charset (``decode_text``) or the first of a list of charsets in which every byte
sequence of the content means something (``decode_first_fit``). Nothing is guessed from letter
statistics.
"""

import codecs
from collections.abc import Sequence


from pyspark.sql import Column
from pyspark.sql import functions as F

# Charsets in which every byte sequence is valid, so that decoding cannot fail.
SAFE_FALLBACKS = ("ISO-8859-1",)

# One UTF-16 unit or surrogate pair, over bytes shown as ISO-8859-1 characters.
_UNIT_BE = r"(?s)\G(?:[\x00-\xd7\xe0-\xff].|[\xd8-\xdb].[\xdc-\xdf].)"
_UNIT_LE = r"(?s)\G(?:.[\x00-\xd7\xe0-\xff]|.[\xd8-\xdb].[\xdc-\xdf])"


# The same for a UTF-32 unit.
_FOUR_BE = r"(?s)\G(?:\x00\x00[\x00-\xd7\xe0-\xff].|\x00[\x01-\x10]..)"
_FOUR_LE = r"(?s)\G(?:.[\x00-\xd7\xe0-\xff]\x00\x00|..[\x01-\x10]\x00)"


def is_utf8(content: Column) -> Column:
    return F.is_valid_utf8(content.cast("string"))


def is_utf32(content: Column) -> Column:
    """A byte order mark followed by well-formed UTF-32. Its little-endian mark begins like
    that of UTF-16, so it is asked for first."""
    mark = F.hex(F.substring(content, 1, 4))
    as_chars = F.decode(content, "ISO-8859-1")
    be = (mark == "0000FEFF") & (F.regexp_replace(as_chars, _FOUR_BE, "") == "")
    le = (mark == "FFFE0000") & (F.regexp_replace(as_chars, _FOUR_LE, "") == "")
    return be | le


def is_utf16(content: Column) -> Column:
    """A byte order mark followed by well-formed UTF-16, and not the mark of UTF-32.

    Checked in full because ``decode`` fails the job on a malformed sequence.
    """
    mark = F.hex(F.substring(content, 1, 2))
    as_chars = F.decode(content, "ISO-8859-1")
    be = (mark == "FEFF") & (F.regexp_replace(as_chars, _UNIT_BE, "") == "")
    le = (mark == "FFFE") & (F.regexp_replace(as_chars, _UNIT_LE, "") == "")
    return (be | le) & (F.hex(F.substring(content, 1, 4)) != "FFFE0000")


def has_nul(content: Column) -> Column:
    return F.contains(content, F.lit(b"\x00"))


def decode_text(content: Column, fallback: str | None = "ISO-8859-1") -> Column:
    """Text of a binary column, null where no attempt fits."""
    if fallback is not None and fallback not in SAFE_FALLBACKS:
        raise ValueError(f"fallback must be None or one of {SAFE_FALLBACKS}")
    text = F.when(is_utf8(content), F.decode(content, "UTF-8"))
    text = text.when(is_utf32(content), F.decode(content, "UTF-32"))
    text = text.when(is_utf16(content), F.decode(content, "UTF-16"))
    return text.otherwise(F.decode(content, fallback)) if fallback else text


def _in_charset(escaped: Column, charset: str) -> Column:
    """Text of percent-escaped bytes in any charset of the Java runtime; a sequence without a
    meaning becomes U+FFFD. ``decode`` knows the Unicode charsets and Latin-1 only, and fails the
    job on such a sequence."""
    if charset in SAFE_FALLBACKS:
        return F.decode(F.unhex(F.replace(escaped, F.lit("%"), F.lit(""))), charset)
    return F.try_reflect(F.lit("java.net.URLDecoder"), F.lit("decode"), escaped, F.lit(charset))


def decode_first_fit(content: Column, charsets: Sequence[str] = ()) -> Column:
    """``text`` and ``charset`` of a binary column.

    UTF-8, UTF-32 and UTF-16 come first, as in ``decode_text``; then ``charsets`` in the given
    order, of which the first wins that gives every byte a meaning. Both fields are null where
    none fits, and where the content is null. Put charsets that leave many sequences without a
    meaning first: ISO-8859-1 fits always. Only content that is no Unicode is decoded further.
    """
    for charset in charsets:
        codecs.lookup(charset)  # a misspelt name is an error here, not a charset that never fits

    def found(text: Column, charset: str) -> Column:
        return F.struct(text.alias("text"), F.lit(charset).alias("charset"))

    utf8, utf32, utf16 = is_utf8(content), is_utf32(content), is_utf16(content)
    unicode = F.coalesce(utf8 | utf32 | utf16, F.lit(True))
    escaped = F.when(~unicode, F.regexp_replace(F.hex(content), "(..)", "%$1"))
    tried = [found(_in_charset(escaped, charset), charset) for charset in charsets]
    nothing = F.struct(F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("charset"))
    fits = F.filter(F.array(*tried, nothing), lambda x: ~F.coalesce(F.contains(x["text"], F.lit("\ufffd")), F.lit(False)))
    return (
        F.when(utf8, found(F.decode(content, "UTF-8"), "UTF-8"))
        .when(utf32, found(F.decode(content, "UTF-32"), "UTF-32"))
        .when(utf16, found(F.decode(content, "UTF-16"), "UTF-16"))
        .otherwise(F.when(content.isNull(), nothing).otherwise(F.get(fits, F.lit(0))))
    )


def is_text(content: Column) -> Column:
    """Not empty, and either free of NUL bytes or marked UTF-16 or UTF-32."""
    plain = ~has_nul(content)
    return F.coalesce((F.octet_length(content) > 0) & (plain | is_utf16(content) | is_utf32(content)), F.lit(False))


def mime_type(content: Column) -> Column:
    """``n/a`` for a file that could not be opened, else text or not."""
    return (
        F.when(content.isNull(), F.lit("n/a"))
        .when(is_text(content), F.lit("text/plain"))
        .otherwise(F.lit("application/octet-stream"))
    )
