"""Chat formatting that is checked by reading it back. Native expressions only.

A turn is rendered as ``### role:``, a line break, the text, ``</turn>`` and a line break.
Wherever ``### `` begins a line or follows a backslash, and wherever ``</turn>`` stands, the
reader sees a mark. In escaped text a backslash is doubled and ``\\-``, which stands for nothing,
breaks up control strings.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD_END, CLOSE = "### ", ":\n", "</turn>\n"
LEVELS = 3
MARK = r"(?<![^\n\\])### |</turn>"


def escape(value: Column, level: int) -> Column:
    """0: as it is; 1: control strings broken up; 2: every character on its own."""
    if level == 0:
        return value
    doubled = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    if level == 1:
        for string, broken in (("###", "#\\-##"), ("</turn>", "<\\-/turn>"), (":", ":\\-")):
            doubled = F.replace(doubled, F.lit(string), F.lit(broken))
        return doubled
    return F.regexp_replace(doubled, r"([^\\])", r"$1\\-")


def unescape(value: Column) -> Column:
    return F.regexp_replace(value, r"\\(?:-|(\\))", "$1")


def render(turns: Column, level: int) -> Column:
    # text needs no broken colons: only the head ends at one
    def one(turn):
        text = escape(turn["text"], level)
        if level == 1:
            text = F.replace(text, F.lit(":\\-"), F.lit(":"))
        return F.concat(F.lit(OPEN), escape(turn["role"], level), F.lit(HEAD_END), text, F.lit(CLOSE))

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation: role and text, unescaped, and the text as written.

    Every mark ends what stands before it. Between an opening and a closing mark is a turn, whose
    head goes up to the first colon before a line break; between a closing and an opening mark is
    nothing but a line break.
    """
    parts = F.split(formatted, MARK)
    parts = F.filter(parts, lambda _, i: i % 2 == 1)

    def one(part):
        head = F.instr(part, F.lit(HEAD_END))
        raw = F.substring(part, head + 2, F.length(part))
        role = F.substring(part, F.lit(1), head - 1)
        return F.struct(unescape(role).alias("role"), unescape(raw).alias("text"), raw.alias("raw"))

    return F.transform(parts, one)


def _same(formatted: Column, turns: Column) -> Column:
    read = F.transform(parse(formatted), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return read == turns


def format_chats(
    conversations: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One formatted text per conversation, with the character spans that count for the loss.

    Every conversation is rendered as it is, read back by the parser and compared with its
    source; where the two differ it is escaped, and where they still differ every character
    is, so what is returned has been recovered exactly. ``level`` tells which was needed.
    ``loss_spans`` are start and end (exclusive), in characters of ``formatted``, of the
    texts of ``loss_role`` as written there, marks not included.

    Turns go by number; rows that share a number go by role and text, a null number comes
    first. A null role or text counts as empty; repeated rows are repeated turns; rows
    without a key form one conversation; an empty table gives no rows. Other columns are not
    read. A conversation is one text, so its turns meet in one row whatever their number.
    """
    rows = conversations.select(
        F.col(key).alias("_key"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("_turn"),
    )
    chats = rows.groupBy("_key").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    turns = F.transform(
        "_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    )
    chats = chats.select("_key", turns.alias("_turns"))
    formatted, level = render(F.col("_turns"), LEVELS - 1), F.lit(LEVELS - 1)
    for n in reversed(range(LEVELS - 1)):
        attempt = render(F.col("_turns"), n)
        good = _same(attempt, F.col("_turns"))
        formatted, level = F.when(good, attempt).otherwise(formatted), F.when(good, n).otherwise(level)
    chats = chats.select("_key", formatted.alias("formatted"), level.alias("level"))
    return chats.select(
        F.col("_key").alias(key), "formatted", "level", _spans(loss_role).alias("loss_spans")
    )


def _spans(loss_role: str) -> Column:
    """Spans of the loss, by adding up the lengths of the parts of the formatted text."""
    parts = F.split("formatted", CLOSE)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state, part):
        head = F.instr(part, F.lit(HEAD_END))
        own = unescape(F.substring(part, F.lit(len(OPEN) + 1), head - 1 - len(OPEN)))
        first, last = state["at"] + head + 1, state["at"] + F.length(part)
        span = F.array(F.struct(first.alias("start"), last.alias("end")))
        spans = F.when(own == loss_role, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((last + len(CLOSE)).alias("at"), spans.alias("spans"))

    return F.aggregate(parts, start, step, lambda state: state["spans"])
