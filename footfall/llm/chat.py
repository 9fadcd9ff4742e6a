"""Chat formatting checked by a grammar round trip.

Grammar of a formatted conversation: turns, each ``### Role: text </turn>`` and a line feed.

    turn := "### " role ": " text " </turn>\\n"

Text is written as it is. The result is parsed again by the same deterministic rules and compared with the
source; conversations that do not come back have every conflicting role and text escaped, and only those.
The escape is a bijection: in an escaped text a backslash always starts a two-character code and
no control string is left, so the second reading is identical.

Defined results: turns are ordered by number (null first), then role and text; a null text is
empty and a null role is the empty role; rows with a null conv_id form one conversation. Repeated
rows stay. A conversation is one row, as the format is one string per conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
# Control strings and their codes. The backslash comes first when escaping and last
# when reading; ": " only matters in roles, but one alphabet serves both.
CODES = (("\\", "\\e"), ("</turn>", "\\t"), ("###", "\\h"), (": ", "\\c"))
LOSS_ROLE = "assistant"


def escape(text: Column, role: bool = False) -> Column:
    for plain, code in CODES if role else CODES[:3]:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _parse_turn(turn: Column) -> Column:
    """One turn without its closing string: header up to the first ": ", the rest is text.

    A turn mark inside the text is an error of the grammar: the text reads as null."""
    body = F.substring(turn, F.lit(len(OPEN) + 1), F.char_length(turn) - len(OPEN) - 1)
    at = F.instr(body, MIDDLE)
    text = F.substring(body, at + len(MIDDLE), F.char_length(body))
    return F.struct(
        unescape(F.substring(body, F.lit(1), at - 1)).alias("role"),
        F.when(~F.contains(text, F.lit("###")), unescape(text)).alias("text"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text). Every closing string closes a turn."""
    parts = F.split(formatted, r"</turn>\n?")
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), _parse_turn)


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), t["text"], F.lit(CLOSE))), "")


def _conflicts(part: Column, role: bool = False) -> Column:
    """Whether a part cannot stand as it is."""
    return (escape(part, role) != part) if role else (
        F.contains(part, F.lit("</turn>")) | F.contains(part, F.lit("###")) | (unescape(part) != part)
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), formatted, loss_spans (start, length of each assistant text, 1-based)."""
    turn = F.struct(
        F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_rows"))
    talks = talks.select("conv_id", F.transform("_rows", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    talks = talks.withColumn("_plain", _render(F.col("turns")))
    talks = talks.withColumn("_same", parse(F.col("_plain")) == F.col("turns"))
    escaped = F.transform(
        "turns",
        lambda t: F.struct(
            F.when(_conflicts(t["role"], True), escape(t["role"], True)).otherwise(t["role"]).alias("role"),
            F.when(_conflicts(t["text"]), escape(t["text"])).otherwise(t["text"]).alias("text"),
        ),
    )
    talks = talks.withColumn("_written", F.when(F.col("_same"), F.col("turns")).otherwise(escaped))
    talks = talks.withColumn("_again", F.when(~F.col("_same"), _render(F.col("_written"))))
    # The escaped form is read once more: what does not come back is an error of the grammar, never a silent loss.
    broken = F.raise_error(F.lit("a conversation does not come back from its escaped form"))
    checked = F.when(parse(F.col("_again")) == F.col("turns"), F.col("_again")).otherwise(broken.cast("string"))
    talks = talks.withColumn("formatted", F.when(F.col("_same"), F.col("_plain")).otherwise(checked))
    # Places in the formatted text, by a running sum over the turns.
    spans = F.aggregate(
        "_written",
        F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.char_length(_header(t)) + F.char_length(t["text"]) + len(CLOSE)).alias("at"),
            F.when(
                t["role"] == LOSS_ROLE,
                F.concat(s["spans"], F.array(F.struct((s["at"] + F.char_length(_header(t))).alias("start"), F.char_length(t["text"]).alias("length")))),
            ).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return talks.select("conv_id", "turns", "formatted", spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted text says: conv_id, turns, loss_text (under the mask, unescaped)."""
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"], s["length"]))), "")
    return formatted.select("conv_id", parse(F.col("formatted")).alias("turns"), loss.alias("loss_text"), "formatted")


def digest(formatted: DataFrame) -> DataFrame:
    """Contract columns, all read from the formatted text and its mask."""
    back = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
