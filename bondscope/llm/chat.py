"""Chat formatting with a grammar that reads its own output back."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed marks of the template, and the control strings that are escaped inside texts.
ROLE, TEXT, LOSS, END = "<|role|>", "<|text|>", "<|loss|>", "<|end|>"
CONTROL = r"(<|\[)(\\*)(\||/?s>|/?INST\])"
ESCAPED = r"(<|\[)\\(\\*)(\||/?s>|/?INST\])"
LEARNED = "assistant"
CHUNK = 64


def escape(text: Column) -> Column:
    """One backslash more inside every control string; ``unescape`` takes it out again."""
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(ROLE), role, F.when(role == LEARNED, LOSS).otherwise(TEXT), text, F.lit(END))


def turns(formatted: Column) -> Column:
    """Parse: array of structs (role, text, learned) of the turns in a rendered text."""
    parts = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")
    body = lambda p: F.substring(p, F.lit(len(ROLE) + 1), F.length(p))
    halves = lambda p: F.split(body(p), r"<\|(?:text|loss)\|>")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.get(halves(p), F.lit(0))).alias("role"),
        unescape(F.get(halves(p), F.lit(1))).alias("text"),
        F.contains(p, F.lit(LOSS)).alias("learned")))


def safe_turn(role: Column, text: Column) -> Column:
    """The plain rendering if it parses back to this one turn, else the escaped one."""
    plain = rendered(role, text)
    same = turns(plain) == F.array(F.struct(role.alias("role"), text.alias("text"), (role == LEARNED).alias("learned")))
    return F.when(same, plain).otherwise(rendered(escape(role), escape(text)))


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id and the rendered text of every conversation of (conv_id, turn, role, text).

    Turns are in order of turn (null first), then role and text; null roles and texts are
    empty. Texts between the loss mark and the end mark are learned. Turns are joined in
    chunks of CHUNK before a conversation, so that long ones arrive as few rows. A null
    conv_id is a conversation. Repeated rows are turns of their own.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("chat", safe_turn(F.col("role"), F.col("text")))
    # Ordered by the source text, as the escaped one may sort otherwise.
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda s: s["chat"]), "")
    chunks = rows.groupBy("conv_id", F.floor(F.col("turn") / CHUNK).alias("chunk")).agg(
        joined(F.struct(F.coalesce("turn", F.lit(-(2**63))).alias("turn"), "role", "text", "chat")).alias("chat"))
    return chunks.groupBy("conv_id").agg(
        joined(F.struct(F.coalesce("chunk", F.lit(-(2**63))).alias("chunk"), "chat")).alias("formatted"))


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of the parsed output: one row for each row of ``chats`` (conv_id, formatted)."""
    parsed = chats.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), turns(F.col("formatted")).alias("t"))
    source = F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("t", lambda t: t["learned"]), lambda t: t["text"]), "")
    return parsed.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.sha2(source, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
