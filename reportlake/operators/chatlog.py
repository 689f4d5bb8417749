"""Chat-log shaping as table jobs: session titles, session index, transcript flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.operators.spread import Running, lead, spread_windows

# Fixed values that must equal the reference behaviour.
TITLE_CHARS = 50

MESSAGE_SCHEMA = ("array<struct<role:string,content:string,"
                  "tool_calls:array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>,"
                  "tool_call_id:string>>")


def session_titles(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Title = first ``TITLE_CHARS`` characters of the first user message of each session.
    ``min_by`` is reduced map-side, so a huge session sends one row per task."""
    users = turns.where(F.col("role") == "user")
    return users.groupBy(conv).agg(F.substring(F.min_by("text", turn), 1, TITLE_CHARS).alias("title"))


def session_index(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row per session, newest first: title, message count, last turn. One pass: the title comes from the
    first user message."""
    user = F.col("role") == "user"
    title = F.substring(F.min_by(F.when(user, F.col("text")), F.when(user, F.col(turn))), 1, TITLE_CHARS)
    return (turns.groupBy(conv).agg(F.count("*").alias("n_messages"), F.max(turn).alias("last_turn"), title.alias("title"))
            .orderBy(F.desc(conv)))


def transcript_rows(turns: DataFrame) -> DataFrame:
    """Visible transcript of a table-form log: system messages dropped, user messages kept,
    assistant messages kept when their text is not empty."""
    visible = (F.col("role") == "user") | ((F.col("role") == "assistant") &
                                           F.coalesce(F.col("text") != "", F.lit(False)))
    return turns.where(visible)


def pair_latest(events: DataFrame, session: str, order: list[str], is_call: str, block: int | None = None) -> DataFrame:
    """The calls among ``events`` with ``content`` of the result that each got: a result goes to the latest call before it
    that has none yet. A result without content fills nothing, one that finds no open call is dropped, each is used once.

    Calls and results are the brackets of a stack: a call opens the level that the running count of calls less results
    reaches, a result closes the level it starts from, so the pairs are neighbours in (session, level). Sessions of any
    length are spread over blocks."""
    step = F.when(F.col(is_call), 1).otherwise(-1)
    e = events.filter(F.col(is_call) | (F.coalesce("content", F.lit("")) != "")).withColumn("__step", step)
    e = spread_windows(e, [session], [(o, True) for o in order], {"__depth": Running("sum", "__step")}, block)
    e = e.withColumn("__level", F.col("__depth") + F.when(F.col(is_call), 0).otherwise(1))
    e = spread_windows(e, [session, "__level"], [(o, True) for o in order], {"__next": lead("__step"), "__got": lead("content")}, block)
    return e.filter(is_call).withColumn("content", F.when(F.col("__next") == -1, F.col("__got"))).drop(
        "__step", "__depth", "__level", "__next", "__got")


def flatten_messages(sessions: DataFrame, session_col: str = "session_id",
                     messages_col: str = "messages", pairing: str = "id") -> DataFrame:
    """JSON message lists → visible transcript rows ``(session, pos, sub, role, content,
    tool_name, tool_args, tool_result)``: system dropped, one row per tool call, a tool
    result attached to the call with the same ``tool_call_id`` (``pairing="id"``: an equi-join, the first result of an
    id counts) or to the latest call before it without one (``pairing="latest"``, as the reference's page does)."""
    msgs = sessions.select(session_col, F.posexplode(F.from_json(messages_col, MESSAGE_SCHEMA)).alias("pos", "m"))
    user = msgs.where(F.col("m.role") == "user").select(
        session_col, "pos", F.lit(0).alias("sub"), F.lit("user").alias("role"),
        F.coalesce("m.content", F.lit("")).alias("content"))
    text = msgs.where((F.col("m.role") == "assistant") & F.col("m.tool_calls").isNull()
                      & (F.coalesce(F.col("m.content"), F.lit("")) != "")).select(
        session_col, "pos", F.lit(0).alias("sub"), F.lit("assistant").alias("role"), F.col("m.content").alias("content"))
    calls = (msgs.where((F.col("m.role") == "assistant") & F.col("m.tool_calls").isNotNull())
             .select(session_col, "pos", F.posexplode("m.tool_calls").alias("sub", "c"))
             .select(session_col, "pos", "sub", F.col("c.id").alias("call_id"),
                     F.col("c.function.name").alias("tool_name"), F.col("c.function.arguments").alias("tool_args")))
    results = msgs.where(F.col("m.role") == "tool").select(
        session_col, "pos", F.col("m.tool_call_id").alias("call_id"), F.col("m.content").alias("content"))
    if pairing == "latest":
        events = calls.withColumn("is_call", F.lit(True)).unionByName(
            results.withColumn("is_call", F.lit(False)).withColumn("sub", F.lit(0)), allowMissingColumns=True)
        tools = pair_latest(events, session_col, ["pos", "sub"], "is_call")
    else:
        once = results.groupBy(session_col, "call_id").agg(F.min_by("content", "pos").alias("content"))
        tools = calls.join(once, [session_col, "call_id"], "left")
    tools = tools.select(session_col, "pos", "sub", F.lit("tool").alias("role"), F.coalesce("content", F.lit("")).alias("content"),
                         "tool_name", "tool_args")
    plain = user.unionByName(text).withColumn("tool_name", F.lit(None).cast("string")) \
        .withColumn("tool_args", F.lit(None).cast("string"))
    return plain.unionByName(tools)


# names of the planned API
index = session_index
flatten = flatten_messages
