r"""Chat transcripts rebuilt from event logs.

An event belongs to a conversation and has a sequence number, a kind and, for messages that change,
a message key: ``message`` sets a text, ``delta`` appends to it, ``edit`` replaces it, and
``regenerate`` starts it anew and withdraws the messages that had begun after it. Final messages
are rendered with a template whose control strings are escaped inside roles and texts: an opening
bracket, any number of backslashes and the rest of a control string get one backslash more, which
reading back takes away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenhand.llm.tables import named

OPEN, ROLE_END, CLOSE = "<s>[INST]", "[/INST]", "</s>"
CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"
TURN = r"(?s)<s>\[INST\](.*?)\[/INST\](.*?)</s>"
TRAINED_ROLE = "assistant"

#: Deltas that a text is streamed in at most, their least length, and sequence numbers between messages.
PIECES, LEAST_PIECE, STEP = 16, 64, 32


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def final_messages(events: DataFrame) -> DataFrame:
    """Messages as they stand at the end of the log: conv, start, role, text.

    ``events`` has conv, seq, kind, msg, role, text. An event without ``msg`` is a message of its
    own; NULL text is empty, a NULL kind counts as ``message``, a NULL seq comes first. A message
    keeps the place of its first event and the first role given. Events of one message that share
    a seq are folded in order of kind and text.
    """
    events = events.select(
        "conv", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "msg", "role", F.coalesce("text", F.lit("")).alias("text")
    )
    whole = events.filter(F.col("msg").isNull()).select(
        "conv", F.col("seq").alias("start"), F.lit(None).cast("long").alias("again"), "role", "text"
    )
    log = events.filter(F.col("msg").isNotNull()).groupBy("conv", "msg").agg(
        F.sort_array(F.collect_list(F.struct("seq", "kind", "text", "role"))).alias("log"),
        F.min("seq").alias("start"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"),
    )
    # the text is what follows the last event that sets it
    resets = F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i))
    since = F.greatest(F.coalesce(F.array_max(resets), F.lit(0)), F.lit(0))
    folded = log.withColumn("since", since).select(
        "conv",
        "start",
        "again",
        F.get(F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull()), F.lit(0)).alias("role"),
        F.array_join(F.transform(F.slice("log", F.col("since") + 1, F.size("log")), lambda e: e["text"]), "").alias("text"),
    )
    before = Window.partitionBy("conv").orderBy("start", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    stands = whole.unionByName(folded).withColumn("withdrawn", F.max("again").over(before))
    return stands.filter(F.col("withdrawn").isNull() | (F.col("withdrawn") <= F.col("start"))).select(
        "conv", "start", "role", "text"
    )


def render(messages: DataFrame) -> DataFrame:
    """One row for each conversation: conv, formatted, loss (spans of text to learn, in code points).

    Rendering makes one string of a conversation, so a conversation has to fit into a row.
    """
    role = F.coalesce("role", F.lit(""))
    body = escape(F.col("text"))
    head = F.concat(F.lit(OPEN), escape(role), F.lit(ROLE_END))
    pieces = messages.select("conv", "start", role.alias("role"), "text", head.alias("head"), body.alias("body"))
    size = F.length("head") + F.length("body") + len(CLOSE)
    order = Window.partitionBy("conv").orderBy("start", "role", "text")
    placed = pieces.withColumns(
        {
            "place": F.row_number().over(order),
            "before": F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    )
    span = F.struct((F.col("before") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length"))
    turn = F.struct(
        "place",
        F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
        F.when(F.col("role") == TRAINED_ROLE, span).alias("loss"),
    )
    whole = placed.groupBy("conv").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "conv",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["loss"]), lambda s: s.isNotNull()).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and learned text taken from the rendered strings: conv, roles, texts, learned."""
    found = formatted.select(
        "conv",
        "formatted",
        F.regexp_extract_all("formatted", F.lit(TURN), F.lit(1)).alias("r"),
        F.regexp_extract_all("formatted", F.lit(TURN), F.lit(2)).alias("t"),
        F.transform(
            "loss",
            lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ).alias("learned"),
    )
    return found.select(
        "conv", "formatted", F.transform("r", unescape).alias("roles"), F.transform("t", unescape).alias("texts"), "learned"
    )


def conversation_events(conversations: DataFrame) -> DataFrame:
    """A log that ends in the texts of a table of conversations (conv_id, turn, role, text).

    Each row becomes the events of one message, in one of four ways by a hash of its place: streamed
    in deltas; drafted and edited; drafted, answered, regenerated and streamed again, which withdraws
    the answer; or sent whole. A text is streamed in at most ``PIECES`` deltas of at least
    ``LEAST_PIECE`` code points. Sequence numbers follow turn, role and text.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    turns = conversations.select(
        named("conv_id").alias("conv"),
        named("turn").cast("long").alias("turn"),
        named("role").cast("string").alias("role"),
        named("text").cast("string").alias("text"),
    ).withColumns({"role": role, "text": text})
    placed = turns.withColumn("place", (F.row_number().over(order) - 1).cast("long")).withColumns(
        {
            "way": F.pmod(F.xxhash64("conv", "place"), F.lit(4)),
            "piece": F.greatest(F.ceil(F.length("text") / PIECES), F.lit(LEAST_PIECE)).cast("int"),
        }
    )
    key = F.col("place").cast("string")

    def event(kind: str, content: Column, given: Column | None = None, msg: Column = key) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            msg.alias("msg"),
            (F.lit(None).cast("string") if given is None else given).alias("role"),
            content.alias("text"),
        )

    starts = F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)), F.col("piece"))
    streamed = F.transform(starts, lambda at: event("delta", F.substring("text", at, F.col("piece"))))
    draft = event("message", F.left("text", F.lit(LEAST_PIECE)), F.col("role"))
    answer = event("message", F.lit("withdrawn"), F.col("role"), F.concat(key, F.lit("+")))
    log = (
        F.when(F.col("way") == 0, F.concat(F.array(event("message", F.lit(""), F.col("role"))), streamed))
        .when(F.col("way") == 1, F.array(draft, event("delta", F.lit("...")), event("edit", F.col("text"))))
        .when(F.col("way") == 2, F.concat(F.array(draft, answer, event("regenerate", F.lit(""))), streamed))
        .otherwise(F.array(event("message", F.col("text"), F.col("role"))))
    )
    return placed.select("conv", "place", F.posexplode(log).alias("at", "e")).select(
        "conv", (F.col("place") * STEP + F.col("at")).alias("seq"), "e.kind", "e.msg", "e.role", "e.text"
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss for each conversation; NULL texts and roles are empty.

    Rows that share a turn are ordered by role and text and all stay; a NULL turn comes first;
    rows without conv_id make up one conversation. No rows give no rows; other columns are not read.
    """
    return render(final_messages(conversation_events(conversations))).withColumnRenamed("conv", "conv_id")
