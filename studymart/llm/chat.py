"""Chat formatting from event logs, with DataFrame functions only.

A log has events of conversations. They are folded into final messages: streamed pieces are joined
in order, an edit replaces what a message said, a regeneration drops a message and all after it. The
messages are then rendered with a template whose control strings can't occur in escaped texts.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of events. MESSAGE and DELTA add text, EDIT replaces a message's text so far, REGENERATE
#: discards what was logged before it for its message and for all later messages.
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"
ASSISTANT = "assistant"

# The template. A turn is [INST]<|role|>R<|text|>T[/INST], or <|role|>R<|text|>T</s> of the assistant.
ROLE, TEXT, ASK, ANSWERED, ASKED = "<|role|>", "<|text|>", "[INST]", "</s>", "[/INST]"
#: The first character of a control string, backslashes, the rest. Escaping adds one backslash.
_ESCAPE = r"([<\[])(\\*)(\||/?s>|/?INST\])"
_UNESCAPE = r"([<\[])(\\*)\\(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def final_messages(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) from (conv_id, seq, kind, message, role, text).

    Events count by ``seq``; ties go by role and text, a null seq comes first. A null kind is a
    message, unknown kinds are ignored, null texts are empty, the first role that isn't null is the
    message's. Messages of which nothing is left are dropped. Null ids form a conversation of their
    own. One shuffle, by conversation.
    """
    kind = F.coalesce("kind", F.lit(MESSAGE))
    seq = F.coalesce(F.col("seq").cast("long"), F.lit(-(1 << 62)))
    log = events.select("conv_id", "message", seq.alias("seq"), kind.alias("kind"), "role", "text")
    up_to = Window.partitionBy("conv_id").orderBy("message").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy("conv_id", "message")
    at = lambda name: F.max(F.when(F.col("kind") == name, F.col("seq")))
    log = log.withColumn("dropped", at(REGENERATE).over(up_to)).withColumn("edited", at(EDIT).over(same))
    live = log.filter(
        F.col("kind").isin(MESSAGE, DELTA, EDIT)
        & (F.col("dropped").isNull() | (F.col("seq") > F.col("dropped")))
        & (F.col("edited").isNull() | (F.col("seq") >= F.col("edited")))
    )
    said = F.sort_array(F.collect_list(F.struct("seq", "role", F.coalesce("text", F.lit("")).alias("text"))))
    return (
        live.groupBy("conv_id", "message")
        .agg(said.alias("said"))
        .select(
            "conv_id",
            "message",
            F.get(F.filter("said.role", lambda r: r.isNotNull()), F.lit(0)).alias("role"),
            F.array_join("said.text", "").alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns): a row per conversation.

    ``turns`` has, in order, start and length of each turn in ``formatted`` and start and length of
    its part under the loss mask, in code points; only texts of the assistant are under it. A null
    role is empty. A conversation becomes one string, so it has to fit into a task.
    """
    answer = F.coalesce(F.col("role") == ASSISTANT, F.lit(False))
    role, text = (escape(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ("role", "text"))
    parts = messages.select(
        "conv_id",
        "message",
        answer.alias("answer"),
        F.concat(F.when(answer, "").otherwise(ASK), F.lit(ROLE), role, F.lit(TEXT)).alias("head"),
        text.alias("body"),
        F.when(answer, ANSWERED).otherwise(ASKED).alias("tail"),
    )
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    sized = parts.withColumn("piece", F.concat("head", "body", "tail"))
    sized = sized.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    span = F.struct(
        F.col("start"),
        F.length("piece").cast("long").alias("length"),
        F.when(F.col("answer"), F.col("start") + F.length("head")).alias("loss_start"),
        F.when(F.col("answer"), F.length("body").cast("long")).otherwise(F.lit(0)).alias("loss_length"),
    )
    grouped = sized.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("message", "piece", span.alias("span")))).alias("all")
    )
    return grouped.select("conv_id", F.array_join("all.piece", "").alias("formatted"), F.col("all.span").alias("turns"))


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, turns, formatted): role, text and loss text of each turn, from the string and the mask."""
    pieces = F.filter(F.split("formatted", r"(?<=\[/INST\]|</s>)"), lambda p: p != "")
    both = F.arrays_zip(pieces.alias("piece"), F.col("turns").alias("span"))

    def turn(x):
        piece, span = x["piece"], x["span"]
        head = F.substring_index(F.substring_index(piece, TEXT, 1), ROLE, -1)
        body = F.regexp_extract(piece, r"(?s)<\|text\|>(.*)(?:\[/INST\]|</s>)$", 1)
        masked = F.substring(piece, (span["loss_start"] - span["start"] + 1).cast("int"), span["loss_length"].cast("int"))
        return F.struct(
            unescape(head).alias("role"),
            unescape(body).alias("text"),
            F.coalesce(unescape(masked), F.lit("")).alias("loss_text"),
        )

    # Through a generator, so that a later use of the turns doesn't compute them once for each field.
    turns = F.explode(F.array(F.transform(both, turn))).alias("turns")
    return rendered.select("conv_id", turns, "formatted")


def turn_events(conversations: DataFrame) -> DataFrame:
    """Rows of finished turns (conv_id, turn, role, text) as events, each a message of its own.

    Rows of one turn are ordered by role and text; repeated rows stay repeated.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("seq"),
        F.lit(MESSAGE).alias("kind"),
        F.row_number().over(order).cast("long").alias("message"),
        "role",
        "text",
    )
