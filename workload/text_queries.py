"""Sources, projections and text filters."""

from pyspark.sql import functions as F

from corpuslens.functions import decoding, markers, paths, text
from corpuslens.operators import dedup
from corpuslens.plans.extract import archive_rows
from corpuslens.sources.readers import scan_corpus
from workload.registry import query
from workload.tables import (
    SQL_FILE_NAMES,
    SQL_LINE_BREAK,
    SQL_SLIM,
    SQL_WHITESPACE,
    documents,
    file_names,
    slim_documents,
    sql_stats,
    table,
)



@query(
    "s1_slim_projection",
    f"""SELECT doc_id, repo_name, file_ext, md5(content) AS content_md5, file_size, max_ll,
          ave_ll::DOUBLE AS ave_ll, alphanum_frac::DOUBLE AS alphanum_frac, repo_lang
        FROM {SQL_SLIM}""",
)
def s1(spark, sf):
    return slim_documents(spark, sf).select(
        "doc_id", "repo_name", "file_ext", F.md5("content").alias("content_md5"), "file_size",
        "max_ll", F.col("ave_ll").cast("double").alias("ave_ll"),
        F.col("alphanum_frac").cast("double").alias("alphanum_frac"), "repo_lang",
    )


@query("s2_scan_as_is", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def s2(spark, sf):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return scan_corpus(spark, f"{sf}/documents.parquet", is_slim=True, schema=schema)


@query(
    "p1_language_from_path",
    "SELECT doc_id, lang AS path_lang FROM documents",
)
def p1(spark, sf):
    path = F.concat(F.lit("corpus/"), "lang", F.lit("/"), "source", F.lit(".parquet"))
    return table(spark, sf, "documents").select(
        "doc_id", paths.parent_name(path).alias("path_lang")
    )


@query(
    "p2_download_targets",
    """SELECT url, split_part(url, '/', -2) AS lang, split_part(url, '/', -1) AS file_name,
         'landing/' || split_part(url, '/', -2) || '/' || split_part(url, '/', -1) AS target_path
       FROM pages""",
)
def p2(spark, sf):
    return paths.plan_downloads(table(spark, sf, "pages"), "landing/")


@query(
    "p3_max_line_length",
    f"SELECT doc_id, max_line_length FROM {sql_stats('documents', 'text')}",
)
def p3(spark, sf):
    longest = text.max_line_length(F.col("text")).cast("bigint")
    return documents(spark, sf).select("doc_id", longest.alias("max_line_length"))


@query(
    "p4_text_stats",
    f"""SELECT doc_id, size, max_line_length, avg_line_length, alphanum_fraction
        FROM {sql_stats('documents', 'text')}""",
)
def p4(spark, sf):
    return text.with_text_stats(documents(spark, sf), "text").select(
        "doc_id", "size", "max_line_length", "avg_line_length", "alphanum_fraction"
    )


@query(
    "p4_text_stats_pages",
    f"""SELECT page_id, size, max_line_length, avg_line_length, alphanum_fraction
        FROM {sql_stats('pages', 'html')}""",
)
def p4_pages(spark, sf):
    return text.with_text_stats(table(spark, sf, "pages"), "html").select(
        "page_id", "size", "max_line_length", "avg_line_length", "alphanum_fraction"
    )


@query(
    "p5_text_size",
    """SELECT doc_id, length(text)::DOUBLE AS chars, length(text) / 1024.0::DOUBLE AS kb,
         length(text) / 1048576.0::DOUBLE AS mb, length(text) / 1073741824.0::DOUBLE AS gb
       FROM documents""",
)
def p5(spark, sf):
    size = F.length("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        text.text_size(size, "chars").cast("double").alias("chars"),
        *[text.text_size(size, unit).alias(unit.lower()) for unit in ("KB", "MB", "GB")],
    )


@query(
    "p6_size_units",
    """SELECT source, sum(octet_length(encode(text)))::BIGINT AS b,
         sum(octet_length(encode(text)))::DOUBLE / 1024 AS kb,
         sum(octet_length(encode(text)))::DOUBLE / 1048576 AS mb,
         sum(octet_length(encode(text)))::DOUBLE / 1073741824 AS gb
       FROM documents GROUP BY source""",
)
def p6(spark, sf):
    total = F.sum(F.octet_length("text"))
    return table(spark, sf, "documents").groupBy("source").agg(
        *[text.byte_size(total, unit).alias(unit) for unit in ("b", "kb", "mb", "gb")]
    )


@query(
    "p7_remove_whitespace",
    f"""SELECT doc_id, length(t) AS n, md5(t) AS stripped_md5
        FROM (SELECT doc_id, regexp_replace(text, '{SQL_WHITESPACE}', '', 'g') AS t
              FROM documents)""",
)
def p7(spark, sf):
    return (
        documents(spark, sf)
        .select("doc_id", text.remove_whitespace(F.col("text")).alias("t"))
        .select("doc_id", F.length("t").cast("bigint").alias("n"), F.md5("t").alias("stripped_md5"))
    )


@query(
    "p8_byte_strings",
    r"""SELECT doc_id, length(r) AS n, md5(r) AS replaced_md5
        FROM (SELECT doc_id, regexp_replace(
                text || ' b''' || repeat('é', (80 + doc_id % 40)::INTEGER) || ''' ' || text,
                'b''([^\x00-\x7F]{100,})''', '<BYTE_ENCODED_STRING>', 'g') AS r
              FROM documents)""",
)
def p8(spark, sf):
    # a run of 80 to 119 accented letters between two copies of the text
    run = F.repeat(F.lit("é"), (F.col("doc_id") % 40 + 80).cast("int"))
    body = F.concat(F.col("text"), F.lit(" b'"), run, F.lit("' "), F.col("text"))
    return (
        documents(spark, sf)
        .select("doc_id", text.replace_byte_strings(body).alias("r"))
        .select("doc_id", F.length("r").cast("bigint").alias("n"), F.md5("r").alias("replaced_md5"))
    )


@query(
    "p9_name_and_extension",
    f"""SELECT doc_id, file_name, split_part(file_name, '.', -1) AS extension
        FROM {SQL_FILE_NAMES}""",
)
def p9(spark, sf):
    root = F.lit("landed/repo")
    full = F.concat_ws("/", root, "file_name")
    return file_names(spark, sf).select(
        "doc_id",
        paths.relative_name(full, root).alias("file_name"),
        paths.extension(F.col("file_name")).alias("extension"),
    )


def encoded(spark, sf):
    """Documents as UTF-8, as Latin-1 and as marked UTF-16 in turn."""
    narrow = F.regexp_replace(F.col("text"), r"[^\x00-\xff]", "?")
    content = (
        F.when(F.col("doc_id") % 3 == 0, F.encode(F.col("text"), "UTF-8"))
        .when(F.col("doc_id") % 3 == 1, F.encode(narrow, "ISO-8859-1"))
        .otherwise(F.encode(F.col("text"), "UTF-16"))
    )
    return documents(spark, sf).withColumn("content", content)


@query(
    "p10_decode",
    r"""SELECT doc_id, md5(CASE WHEN doc_id % 3 = 1
                                THEN regexp_replace(text, '[^\x00-\x{ff}]', '?', 'g')
                                ELSE text END) AS text_md5
        FROM documents""",
)
def p10(spark, sf):
    decoded = decoding.decode_text(F.col("content"))
    return encoded(spark, sf).select("doc_id", F.md5(decoded).alias("text_md5"))


# bytes of three charsets as characters of ISO-8859-1, and what they mean
_ASCII = r"regexp_replace(text, '[^\x00-\x5b\x5d-\x7d]', '?', 'g')"


@query(
    "p10_decode_charsets",
    f"""SELECT doc_id, md5(CASE doc_id % 4 WHEN 0 THEN text
            WHEN 1 THEN chr(160) || chr(8220) || a || chr(8221)
            WHEN 2 THEN replace(a, 'a', chr(12354)) ELSE chr(160) || chr(1106) || a END) AS text_md5,
          CASE WHEN doc_id % 4 = 0 OR doc_id % 4 = 2 AND NOT contains(a, 'a') THEN 'UTF-8'
            WHEN doc_id % 4 = 1 THEN 'windows-1252' WHEN doc_id % 4 = 2 THEN 'Shift_JIS'
            ELSE 'windows-1251' END AS charset
        FROM (SELECT doc_id, text, {_ASCII} AS a FROM documents)""",
)
def p10_charsets(spark, sf):
    """A quarter of the texts each in UTF-8, windows-1252, Shift_JIS and windows-1251."""
    docs = documents(spark, sf).withColumn("a", F.regexp_replace("text", r"[^\x00-\x5b\x5d-\x7d]", "?"))
    latin = (
        F.when(F.col("doc_id") % 4 == 1, F.concat(F.lit("\xa0\x93"), "a", F.lit("\x94")))
        .when(F.col("doc_id") % 4 == 2, F.replace("a", F.lit("a"), F.lit("\x82\xa0")))
        .otherwise(F.concat(F.lit("\xa0\x90"), "a"))
    )
    content = F.when(F.col("doc_id") % 4 == 0, F.encode("text", "UTF-8")).otherwise(F.encode(latin, "ISO-8859-1"))
    decoded = decoding.decode_first_fit(content, ["Shift_JIS", "windows-1252", "windows-1251"])
    rows = docs.select("doc_id", decoded.alias("decoded"))
    return rows.select("doc_id", F.md5("decoded.text").alias("text_md5"), "decoded.charset")


@query(
    "p11_archive_rows",
    """SELECT md5(text) AS text_md5, source AS repo_name, 'doc_' || doc_id AS file_name,
         'text/plain' AS mime_type
       FROM documents WHERE length(text) BETWEEN 16 AND 1048576""",
)
def p11(spark, sf):
    files = documents(spark, sf).select(
        F.col("source").alias("repo_name"),
        F.concat(F.lit("doc_"), "doc_id").alias("file_name"),
        F.encode("text", "UTF-8").alias("content"),
    )
    return archive_rows(files).select(F.md5("text").alias("text_md5"), "meta.*")


@query(
    "p12_flatten_lists",
    """SELECT doc_id, len(w)::BIGINT AS n_words, md5(array_to_string(w, '|')) AS words_md5
       FROM (SELECT doc_id, flatten(list_transform(string_split(text, chr(10)),
                                    lambda line: string_split(line, ' '))) AS w
             FROM documents)""",
)
def p12(spark, sf):
    words = F.transform(F.split(F.col("text"), "\n"), lambda line: F.split(line, " "))
    return (
        documents(spark, sf)
        .select("doc_id", text.flatten_lists(words).alias("w"))
        .select(
            "doc_id",
            F.size("w").cast("bigint").alias("n_words"),
            F.md5(F.array_join("w", "|")).alias("words_md5"),
        )
    )


@query(
    "p12_explode_lists",
    """SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos
       FROM (SELECT doc_id, flatten(list_transform(string_split(text, chr(10)),
                                    lambda line: string_split(line, ' '))) AS w
             FROM documents)""",
)
def p12_explode(spark, sf):
    words = F.transform(F.split(F.col("text"), "\n"), lambda line: F.split(line, " "))
    nested = documents(spark, sf).select("doc_id", words.alias("lines"))
    return text.explode_lists(nested, "lines", "word").select(
        "doc_id", "word", F.col("pos").cast("bigint").alias("pos")
    )


NAME_RULES = """base_name NOT LIKE '.%' AND {searched} NOT LIKE '%.git%'
        AND {searched} NOT LIKE '%LICENSE%' AND {searched} NOT LIKE '%node\\_modules%' ESCAPE '\\'
        AND {searched} NOT LIKE '%.min.%'
        AND split_part(base_name, '.', -1) NOT IN ({blocked})"""
BLOCKED = ", ".join(f"'{e}'" for e in paths.BLOCKED_EXTENSIONS)


@query(
    "f14_valid_names",
    f"""SELECT doc_id, file_name FROM {SQL_FILE_NAMES}
        WHERE {NAME_RULES.format(searched='base_name', blocked=BLOCKED)}""",
)
def f14(spark, sf):
    return file_names(spark, sf).filter(paths.has_valid_name(F.col("file_name"))).select(
        "doc_id", "file_name"
    )


@query(
    "f14_valid_paths",
    f"""SELECT doc_id, file_name FROM {SQL_FILE_NAMES}
        WHERE {NAME_RULES.format(searched='file_name', blocked=BLOCKED)}""",
)
def f14_paths(spark, sf):
    valid = paths.has_valid_name(F.col("file_name"), match_on="path")
    return file_names(spark, sf).filter(valid).select("doc_id", "file_name")


@query(
    "f15_blocked_extensions",
    f"""SELECT doc_id, file_name, split_part(base_name, '.', -1) IN ({BLOCKED}, 'md') AS blocked
        FROM {SQL_FILE_NAMES}""",
)
def f15(spark, sf):
    blocked = paths.extension(F.col("base_name")).isin(paths.blocked_extensions(["md"]))
    return file_names(spark, sf).select("doc_id", "file_name", blocked.alias("blocked"))


@query(
    "f16_text_gate",
    """SELECT doc_id, doc_id % 7 <> 0 AND length(text) > 0 AS is_text,
         CASE WHEN doc_id % 7 <> 0 AND length(text) > 0 THEN 'text/plain'
              ELSE 'application/octet-stream' END AS mime_type
       FROM documents""",
)
def f16(spark, sf):
    # every seventh document has a NUL byte at its end
    body = F.when(F.col("doc_id") % 7 == 0, F.concat(F.col("text"), F.lit("\x00"))).otherwise(F.col("text"))
    content = F.encode(body, "UTF-8")
    return documents(spark, sf).select(
        "doc_id",
        decoding.is_text(content).alias("is_text"),
        decoding.mime_type(content).alias("mime_type"),
    )


@query(
    "f17_keep_text",
    "SELECT doc_id, n_chars FROM documents WHERE length(text) BETWEEN 16 AND 1048576",
)
def f17(spark, sf):
    return table(spark, sf, "documents").filter(text.keep_text(F.col("text"))).select("doc_id", "n_chars")


@query(
    "f18_max_line_length",
    f"""SELECT doc_id, n_chars FROM {sql_stats('documents', 'text')}
        WHERE max_line_length < 1000""",
)
def f18(spark, sf):
    return text.filter_max_line_length(documents(spark, sf)).select("doc_id", "n_chars")


@query(
    "f19_max_text_size",
    "SELECT doc_id, n_chars FROM documents WHERE length(text) / 1048576.0::DOUBLE < 0.002::DOUBLE",
)
def f19(spark, sf):
    return text.filter_max_text_size(table(spark, sf, "documents"), 0.002).select(
        "doc_id", "n_chars"
    )


@query(
    "f20_repeats",
    """SELECT doc_id, contains(text, repeat('an', 2)) AS an_twice,
         contains(text, repeat('e', 3)) AS e_thrice, contains(text, repeat('. ', 2)) AS dots,
         contains(text, repeat('.', 1)) AS dot, contains(text, '') AS none
       FROM documents""",
)
def f20(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        text.has_repeat(F.col("text"), "an", 2).alias("an_twice"),
        text.has_repeat(F.col("text"), "e", 3).alias("e_thrice"),
        text.has_repeat(F.col("text"), ". ", 2).alias("dots"),
        text.has_repeat(F.col("text"), ".", 1).alias("dot"),
        text.has_repeat(F.col("text"), ".", 0).alias("none"),
    )


@query(
    "f20_repeats_benchmark",
    """SELECT item_id, contains(text, repeat('in', 2)) AS in_twice,
         contains(text, repeat('ha', 3)) AS ha_thrice
       FROM benchmark""",
)
def f20_benchmark(spark, sf):
    return table(spark, sf, "benchmark").select(
        "item_id",
        text.has_repeat(F.col("text"), "in", 2).alias("in_twice"),
        text.has_repeat(F.col("text"), "ha", 3).alias("ha_thrice"),
    )


_MARKERS = markers.all_markers()
_MARKER_LIST = ", ".join("'" + m + "'" for m in _MARKERS)
_SQL_MARKED = f"""(
      SELECT doc_id, CASE WHEN doc_id % 3 = 0
                          THEN text || ' ' || ([{_MARKER_LIST}])[(doc_id // 3) % 25 + 1]
                          ELSE text END AS body
      FROM documents)"""


def _sql_any(names):
    return " OR ".join(f"contains(body, '{m}')" for m in names)


_SQL_GROUPS = ", ".join(
    f"CASE WHEN {_sql_any(names)} THEN '{group}' END" for group, names in markers.MARKERS.items()
)
_SQL_FOUND = ", ".join(f"CASE WHEN contains(body, '{m}') THEN '{m}' END" for m in _MARKERS)


@query(
    "f21_generated_markers",
    f"""SELECT doc_id, ({_sql_any(_MARKERS)}) AS generated,
          concat_ws(',', {_SQL_GROUPS}) AS groups, concat_ws(',', {_SQL_FOUND}) AS markers
        FROM {_SQL_MARKED}""",
)
def f21(spark, sf):
    found = marked(spark, sf).select("doc_id", markers.matching_markers(F.col("body")).alias("found"))
    return found.select(
        "doc_id",
        (F.size("found") > 0).alias("generated"),
        F.array_join(markers.groups_of(F.col("found")), ",").alias("groups"),
        F.array_join("found", ",").alias("markers"),
    )


def marked(spark, sf):
    """Documents of which every third ends with one of the markers."""
    listed = F.array(*[F.lit(m) for m in _MARKERS])
    place = (F.floor(F.col("doc_id") / 3) % len(_MARKERS) + 1).cast("int")
    marked = F.concat(F.col("text"), F.lit(" "), F.element_at(listed, place))
    body = F.when(F.col("doc_id") % 3 == 0, marked).otherwise(F.col("text"))
    return documents(spark, sf).select("doc_id", body.alias("body"))


@query(
    "f21_not_generated",
    f"SELECT doc_id, length(body) AS n FROM {_SQL_MARKED} WHERE NOT ({_sql_any(_MARKERS)})",
)
def f21_filter(spark, sf):
    return marked(spark, sf).filter(~markers.is_generated(F.col("body"))).select(
        "doc_id", F.length("body").cast("bigint").alias("n")
    )


@query(
    "d1_distinct_texts",
    f"""SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM (
          SELECT *, row_number() OVER (
              PARTITION BY regexp_replace(text, '{SQL_WHITESPACE}', '', 'g')
              ORDER BY doc_id) AS rn
          FROM documents) WHERE rn = 1""",
)
def d1(spark, sf):
    return dedup.drop_duplicate_texts(documents(spark, sf), "doc_id").select(
        "doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5")
    )


@query(
    "d1_distinct_texts_in_scan",
    f"""SELECT doc_id, lang, md5(text) AS text_md5 FROM (
          SELECT *, row_number() OVER (
              PARTITION BY regexp_replace(text, '{SQL_WHITESPACE}', '', 'g')
              ORDER BY doc_id) AS rn
          FROM documents) WHERE rn = 1""",
)
def d1_in_scan(spark, sf):
    scan = table(spark, sf, "documents").select("doc_id", "lang", "text")
    kept = dedup.drop_duplicate_rows_in_files(scan, order_by="doc_id")
    return kept.select("doc_id", "lang", F.md5("text").alias("text_md5"))


@query(
    "d1_first_of_each_text",
    f"""SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents
        GROUP BY regexp_replace(text, '{SQL_WHITESPACE}', '', 'g')""",
)
def d1_first(spark, sf):
    return dedup.first_of_each_text(documents(spark, sf), "doc_id")


@query(
    "p3_chars_in_lines",
    f"""SELECT doc_id, list_sum(list_transform(string_split_regex(text, '{SQL_LINE_BREAK}'),
                                lambda piece: length(piece)))::BIGINT AS chars_in_lines
        FROM documents""",
)
def p3_lines(spark, sf):
    lengths = text.line_lengths(F.col("text"))
    total = F.aggregate(lengths, F.lit(0).cast("bigint"), lambda acc, n: acc + n)
    return documents(spark, sf).select("doc_id", total.alias("chars_in_lines"))
