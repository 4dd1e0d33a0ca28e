"""Quality rules, tiers, the cascade and its reports."""

from pyspark.sql import functions as F

from corpuslens.functions.text import with_text_stats
from corpuslens.operators import positions, reports, rules
from corpuslens.operators.rules import TIERS, Thresholds
from corpuslens.schemas import SLIM, SLIM_FROM_FULL
from corpuslens.session import materialize
from corpuslens.sources.readers import spread
from workload.registry import query
from workload.tables import (
    SQL_SLIM,
    SQL_SLIM_PAGES,
    documents,
    slim_documents,
    slim_pages,
    sql_slim,
    table,
)

# Tight limits under which every rule rejects some documents.
CUSTOM = Thresholds(
    max_ll=5000, min_len=40, min_max_ll=12, max_size_kbs=6, min_alphanum=0.7,
    max_alphanum=0.825, min_ave_ll=40, min_lines=3,
)


def sql_rules(limits: Thresholds) -> dict[str, str]:
    return {
        "max_ll": f"max_ll <= {limits.max_ll} AND max_ll >= {limits.min_max_ll}",
        "file_too_small": f"file_size >= {limits.min_len}",
        "file_too_large": f"file_size // 1024 <= {limits.max_size_kbs}",
        "alphanum_frac": f"alphanum_frac > {limits.min_alphanum}::FLOAT "
        f"AND alphanum_frac < {limits.max_alphanum}::FLOAT",
        "ave_ll": f"ave_ll > {limits.min_ave_ll}::FLOAT AND NOT isnan(ave_ll)",
        "min_lines": "CASE WHEN ave_ll = 0 THEN file_size > 0 ELSE file_size::DOUBLE / "
        f"ave_ll::DOUBLE >= {limits.min_lines}::DOUBLE END",
    }


def sql_reason(limits: Thresholds) -> str:
    whens = [
        f"WHEN NOT coalesce({cond}, false) THEN '{reason}'"
        for reason, cond in sql_rules(limits).items()
    ]
    return "CASE " + " ".join(whens) + " END"


def sql_labelled(limits: Thresholds, key: str = "doc_id", source: str = SQL_SLIM) -> str:
    return f"""(SELECT *, CASE WHEN reason IS NULL THEN 'kept' ELSE 'rejected' END AS verdict
            FROM (SELECT {key}, repo_lang, file_size, {sql_reason(limits)} AS reason
                  FROM {source}))"""


def labelled(spark, sf, limits):
    """Cascade over the raw text of the documents."""
    rows = documents(spark, sf).withColumn("repo_lang", F.col("lang"))
    return rules.cascade_text(rows, limits, python_gate="off", content="text")


# F1 to F6: each rule on its own, moderate limits ------------------------------------------


RULE_STATS = {
    "max_ll": ["max_line_length"],
    "file_too_small": ["size"],
    "file_too_large": ["size"],
    "alphanum_frac": ["alphanum_fraction"],
    "ave_ll": ["avg_line_length"],
    "min_lines": ["size", "avg_line_length"],
}


def _single_rule(number, reason, limits, suffix=""):
    @query(
        f"f{number}_{reason}{suffix}",
        f"""SELECT doc_id, coalesce({sql_rules(limits)[reason]}, false) AS holds
            FROM {SQL_SLIM}""",
    )
    def build(spark, sf):
        stats = RULE_STATS[reason]
        rows = with_text_stats(documents(spark, sf), "text", stats)
        names = {SLIM_FROM_FULL[field.name]: field for field in SLIM.fields}
        rows = rows.select(
            "doc_id", *[F.col(s).cast(names[s].dataType).alias(names[s].name) for s in stats]
        )
        rule = rules.rules(rows, limits)[number - 1]
        return rows.select("doc_id", F.coalesce(rule.holds, F.lit(False)).alias("holds"))


for _number, _reason in enumerate(rules.RULE_REASONS, start=1):
    _single_rule(_number, _reason, TIERS["moderate"])
    _single_rule(_number, _reason, CUSTOM, "_custom")


# F8 and F9: cascade and kept-only plan in every tier --------------------------------------


def sql_funnel(limits) -> str:
    return f"""WITH l AS (SELECT reason FROM {sql_labelled(limits)}),
            steps(step, rule) AS (VALUES (0, 'original'), (1, 'max_ll'), (2, 'file_too_small'),
              (3, 'file_too_large'), (4, 'alphanum_frac'), (5, 'ave_ll'), (6, 'min_lines'))
            SELECT step, rule, (SELECT count(*) FROM l) - (
              SELECT count(*) FROM l JOIN steps s ON s.rule = l.reason WHERE s.step <= steps.step
            ) AS rows_left FROM steps"""


def _tier(name, limits):
    @query(
        f"f8_cascade_{name}",
        f"SELECT doc_id, verdict, reason FROM {sql_labelled(limits)}",
    )
    def cascade(spark, sf):
        return labelled(spark, sf, limits).select("doc_id", "verdict", "reason")

    @query(
        f"f9_kept_{name}",
        f"SELECT doc_id, file_size FROM {sql_labelled(limits)} WHERE verdict = 'kept'",
    )
    def kept(spark, sf):
        return rules.kept_only(slim_documents(spark, sf), limits).select("doc_id", "file_size")

    @query(
        f"f9_kept_text_{name}",
        f"""SELECT doc_id, file_size, alphanum_frac::DOUBLE AS alphanum_frac
            FROM (SELECT *, {sql_reason(limits)} AS reason FROM {SQL_SLIM}) WHERE reason IS NULL""",
    )
    def kept_text(spark, sf):
        return rules.kept_text(documents(spark, sf), limits, "text").select(
            "doc_id", "file_size", F.col("alphanum_frac").cast("double").alias("alphanum_frac")
        )

    @query(f"a4_funnel_{name}", sql_funnel(limits))
    def funnel(spark, sf):
        return reports.funnel(labelled(spark, sf, limits))


for _name, _limits in {**TIERS, "custom": CUSTOM}.items():
    _tier(_name, _limits)


@query(
    "f8_cascade_pages",
    f"""SELECT page_id, verdict, reason
        FROM {sql_labelled(TIERS['permissive'], 'page_id', SQL_SLIM_PAGES)}""",
)
def f8_pages(spark, sf):
    out = rules.cascade(slim_pages(spark, sf), TIERS["permissive"], python_gate="off")
    return out.select("page_id", "verdict", "reason")


# Documents as Python: all lines are comments, and every second text starts with a statement
# that only Python 2 accepts. SQL cannot parse, but it knows which texts these are.
SQL_PROGRAMS = """(SELECT doc_id, source, CASE WHEN doc_id % 2 = 1 THEN 'print ''x''' || chr(10)
                     ELSE '' END || '# ' || replace(text, chr(10), chr(10) || '# ') AS body
                   FROM documents)"""
SQL_SLIM_PROGRAMS = sql_slim(SQL_PROGRAMS, "body", "doc_id", "source", "'Python'")


@query(
    "f7_syntax_gate",
    f"""SELECT doc_id, CASE WHEN reason IS NULL THEN 'kept' ELSE 'rejected' END AS verdict, reason
        FROM (SELECT doc_id, CASE WHEN reason IS NULL AND doc_id % 2 = 1 THEN 'python2'
                                  ELSE reason END AS reason
              FROM {sql_labelled(TIERS['permissive'], source=SQL_SLIM_PROGRAMS)})""",
)
def f7(spark, sf):
    commented = F.concat(F.lit("# "), F.replace("text", F.lit("\n"), F.lit("\n# ")))
    old = F.when(F.col("doc_id") % 2 == 1, F.lit("print 'x'\n")).otherwise(F.lit(""))
    rows = documents(spark, sf).select(
        "doc_id", F.concat(old, commented).alias("content"), F.lit("Python").alias("repo_lang")
    )
    out = rules.cascade_text(rows, TIERS["permissive"], python_gate="python_only")
    return out.select("doc_id", "verdict", "reason")


@query(
    "f7_gate_skips_other_languages",
    f"SELECT doc_id, verdict, reason FROM {sql_labelled(TIERS['permissive'])}",
)
def f7_others(spark, sf):
    """Prose that does not parse, but is not Python either."""
    rows = documents(spark, sf).withColumn("repo_lang", F.col("lang"))
    out = rules.cascade_text(rows, TIERS["permissive"], "python_only", "text")
    return out.select("doc_id", "verdict", "reason")


@query(
    "f7_gate_on_all_languages",
    f"""SELECT doc_id, CASE WHEN reason IS NULL THEN 'kept' ELSE 'rejected' END AS verdict, reason
        FROM (SELECT doc_id, CASE WHEN reason IS NULL AND doc_id % 2 = 1 THEN 'python2'
                                  ELSE reason END AS reason
              FROM {sql_labelled(TIERS['permissive'], source=SQL_SLIM_PROGRAMS)})""",
)
def f7_all(spark, sf):
    """The gate on rows of another language, which ``python_only`` would let pass."""
    commented = F.concat(F.lit("# "), F.replace("text", F.lit("\n"), F.lit("\n# ")))
    old = F.when(F.col("doc_id") % 2 == 1, F.lit("print 'x'\n")).otherwise(F.lit(""))
    rows = documents(spark, sf).select(
        "doc_id", F.concat(old, commented).alias("content"), F.lit("Ruby").alias("repo_lang")
    )
    out = rules.cascade_text(rows, TIERS["permissive"], python_gate="all")
    return out.select("doc_id", "verdict", "reason")


@query(
    "u1_union_of_rejects",
    f"""SELECT 'documents' AS run, doc_id AS id, reason
        FROM {sql_labelled(TIERS['moderate'])} WHERE verdict = 'rejected'
        UNION ALL
        SELECT 'pages' AS run, page_id AS id, reason
        FROM {sql_labelled(TIERS['moderate'], 'page_id', SQL_SLIM_PAGES)}
        WHERE verdict = 'rejected'""",
)
def u1(spark, sf):
    runs = {
        "documents": slim_documents(spark, sf).withColumnRenamed("doc_id", "id"),
        "pages": slim_pages(spark, sf).withColumnRenamed("page_id", "id"),
    }
    rejects = []
    for name, rows in runs.items():
        out = rules.cascade(rows, TIERS["moderate"], python_gate="off")
        _, rejected = rules.split(out)
        rejects.append(rejected.select(F.lit(name).alias("run"), "id", "reason"))
    return rejects[0].unionByName(rejects[1])


@query(
    "u2_kept_and_rejected",
    f"""SELECT repo_lang, count(*) FILTER (verdict = 'kept') AS kept,
          count(*) FILTER (verdict = 'rejected') AS rejected, count(*) AS total
        FROM {sql_labelled(TIERS['moderate'])} GROUP BY repo_lang""",
)
def u2(spark, sf):
    out = labelled(spark, sf, TIERS["moderate"])
    return out.groupBy("repo_lang").agg(
        F.count_if(F.col("verdict") == "kept").alias("kept"),
        F.count_if(F.col("verdict") == "rejected").alias("rejected"),
        F.count(F.lit(1)).alias("total"),
    )


@query(
    "o3_rejects_in_original_order",
    f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS seq, doc_id, reason
        FROM {sql_labelled(TIERS['moderate'])} WHERE verdict = 'rejected'""",
)
def o3(spark, sf):
    located = table(spark, sf, "documents").select(
        "*", F.col("_metadata.file_path").alias("src_path"),
        F.col("_metadata.row_index").alias("src_row"),
    )
    located = spread(located)
    out = rules.cascade_text(located, TIERS["moderate"], "off", "text", "lang")
    _, rejected = rules.split(out)
    # written first: finding the range boundaries would run the rules a second time
    narrow = materialize(rejected.select("src_path", "src_row", "doc_id", "reason"))
    numbered = positions.with_row_index(narrow, ["src_path", "src_row"], "seq")
    return numbered.select("seq", "doc_id", "reason")
