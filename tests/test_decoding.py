"""An ordered list of charsets."""

import pytest
from pyspark.sql import functions as F

from corpuslens.functions.decoding import decode_first_fit
from corpuslens.plans.extract import archive_rows

LIST = ["Shift_JIS", "windows-1252", "windows-1251"]
CASES = [
    ("plain é".encode(), "plain é", "UTF-8"),
    ("あいう abc 表".encode("shift_jis"), "あいう abc 表", "Shift_JIS"),
    (b"\xa0\x93quoted\x94", "\xa0“quoted”", "windows-1252"),
    ("Ђђ".encode("cp1251") + b"\xa0", "Ђђ\xa0", "windows-1251"),
    ("привет ж ".encode("cp1251"), None, None),  # means something in several
    (b"\x98\x81", None, None),
    ("﻿x".encode("utf-16-le") + "я".encode("utf-16-le"), None, "UTF-16"),
    (b"%41+\xff%", "%41+ÿ%", "windows-1252"),
    (b"", "", "UTF-8"),
    (None, None, None),
]


def test_first_fit_wins(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, content binary")
    out = rows.select("i", decode_first_fit(F.col("content"), LIST).alias("d")).select("i", "d.*")
    got = {r["i"]: (r["text"], r["charset"]) for r in out.collect()}
    for i, (content, text, charset) in enumerate(CASES):
        if charset in ("UTF-16",):
            assert got[i][1] == charset
        elif charset or content is None:
            assert got[i] == (text, charset)
    assert got[4][1] in LIST
    # Python agrees on which charset fits first
    for i, (content, _, _) in enumerate(CASES[:6]):
        fits = []
        for name, codec in [("UTF-8", "utf-8"), ("Shift_JIS", "shift_jis"), ("windows-1252", "cp1252"), ("windows-1251", "cp1251")]:
            try:
                fits.append((content.decode(codec), name))
            except UnicodeDecodeError:
                pass
        assert got[i] == (fits[0] if fits else (None, None))


def test_order_and_last_resort(spark):
    rows = spark.createDataFrame([(b"\x93\x82\xa0",)], "content binary")

    def charset(*names):
        return rows.select(decode_first_fit(F.col("content"), names)["charset"]).first()[0]

    assert charset() is None
    assert charset("windows-1251", "windows-1252") == "windows-1251"
    assert charset("windows-1252", "windows-1251") == "windows-1252"
    assert charset("US-ASCII", "ISO-8859-1") == "ISO-8859-1"
    with pytest.raises(LookupError):
        decode_first_fit(F.col("content"), ["Shift_JSI"])


def test_archive_names_the_charset(spark):
    body = "日本語のテキスト、十六文字以上あります。".encode("shift_jis")
    files = spark.createDataFrame(
        [("r", "a", body), ("r", "b", b"\x98\x81" * 20), ("r", "c", b"sixteen characters")],
        "repo_name string, file_name string, content binary",
    )
    rows = archive_rows(files, charsets=LIST).select("meta.file_name", "charset").collect()
    assert sorted(map(tuple, rows)) == [("a", "Shift_JIS"), ("c", "UTF-8")]
    assert archive_rows(files).columns == ["text", "meta"]
