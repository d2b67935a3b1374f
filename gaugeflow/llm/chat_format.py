r"""Operator 2, chat formatting: conversations of typed content parts as one text each.

A message is (conv_id, turn, role, parts) and a part is (kind, text, ref, tokens). A visitor,
one expression per kind of part, flattens the parts in order: text is escaped, an image,
audio or document becomes a placeholder with its number in the conversation, and its
reference and expanded token count are recorded. The formatted text is, for each turn,

    <|turn|>role<|text|>content<|end|>

Text parts next to each other are escaped as the one text that they make, so no control string
arises between two of them. Control strings inside roles and texts, those of this template and of common others, get a
backslash after their first character; one that already has n backslashes there gets one
more. Taking one away again restores every text, whatever it holds. Placeholders are control
strings that nothing was put into, which tells them from a text that says the same:
`read_messages` gives the parts back, `read_turns` the content as one text.

The loss mask is a list of (start, length) in code points over the formatted text, one for
the content of each assistant turn. Null roles and texts are empty. Turns are in order of
turn, null first, then of role and content, so repeated rows are kept side by side. Null
conv_id is a conversation of its own. Unknown kinds of part are placeholders of that
kind. An empty table gives no rows, other columns are not read. A conversation is one
value and has to fit a task's memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,tokens:int>"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: First character and rest of a control string, with any backslashes between them.
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\]|</?SYS>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def text_parts(text: Column) -> Column:
    """A plain text as the parts of a message."""
    part = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("tokens"),
    )
    return F.array(part.cast(PART))


def _placeholder(kind: Column, number: Column) -> Column:
    return F.concat(F.lit("<|"), F.regexp_replace(kind, "[^A-Za-z0-9_]", "_"), F.lit(":"), number, F.lit("|>"))


def _attached(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) != "text"


#: Stands for an attachment while texts are escaped; the same character in a text is marked as such.
_SIGN, _HERE, _SAID = "\x01", "\x01a", "\x01t"


def _flatten(parts: Column, before: Column) -> Column:
    """The content of a message whose conversation has had `before` attachments."""

    def visit(part: Column) -> Column:
        said = F.replace(F.coalesce(part["text"], F.lit("")), F.lit(_SIGN), F.lit(_SAID))
        return F.when(_attached(part), F.lit(_HERE)).otherwise(said)

    texts = F.split(escape(F.array_join(F.transform(parts, visit), "")), _HERE)
    kinds = F.transform(F.filter(parts, _attached), lambda p: p["kind"])

    def one(text: Column, i: Column) -> Column:
        mark = _placeholder(F.get(kinds, i - 1), (before + i - 1).cast("string"))
        return F.concat(F.when(i > 0, mark).otherwise(""), F.replace(text, F.lit(_SAID), F.lit(_SIGN)))

    return F.array_join(F.transform(texts, one), "")


def format_conversations(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss array<struct<start, length>>, attachments, n_turns."""
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
    rows = messages.select(
        "conv_id",
        F.struct(
            F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts")
        ).alias("message"),
    )
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("message")).alias("messages"))

    def opened(m: Column) -> Column:
        return F.concat(F.lit(TURN), escape(m["role"]), F.lit(TEXT))

    def add(done: Column, m: Column) -> Column:
        attached = F.filter(m["parts"], _attached)
        head, content = opened(m), _flatten(m["parts"], F.size(done["attachments"]))
        span = F.struct(
            (done["chars"] + F.length(head)).cast("bigint").alias("start"),
            F.length(content).cast("bigint").alias("length"),
        )
        none = F.array().cast("array<struct<start:bigint,length:bigint>>")
        kept = F.transform(
            attached,
            lambda p: F.struct(
                p["kind"].alias("kind"), p["ref"].alias("ref"), F.coalesce(p["tokens"], F.lit(1)).alias("tokens")
            ),
        )
        return F.struct(
            F.concat(done["pieces"], F.array(F.concat(head, content, F.lit(END)))).alias("pieces"),
            (done["chars"] + F.length(head) + F.length(content) + len(END)).cast("bigint").alias("chars"),
            F.concat(done["loss"], F.when(m["role"] == "assistant", F.array(span)).otherwise(none)).alias("loss"),
            F.concat(done["attachments"], kept).alias("attachments"),
        )

    start = F.struct(
        F.array().cast("array<string>").alias("pieces"),
        F.lit(0).cast("bigint").alias("chars"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("loss"),
        F.array().cast("array<struct<kind:string,ref:string,tokens:int>>").alias("attachments"),
    )
    made = gathered.select("conv_id", F.aggregate("messages", start, add).alias("m"))
    return made.select(
        "conv_id",
        F.array_join("m.pieces", "").alias("formatted"),
        F.col("m.loss").alias("loss"),
        F.col("m.attachments").alias("attachments"),
        F.aggregate(F.col("m.attachments"), F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias(
            "attachment_tokens"
        ),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as array<struct<role, text>>, control strings restored."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: F.length(p) > 0)

    def one(piece: Column) -> Column:
        # The content is what follows the first mark of text.
        role = F.substring_index(piece, TEXT, 1)
        return F.struct(
            unescape(role.substr(F.lit(len(TURN) + 1), F.length(role))).alias("role"),
            unescape(piece.substr(F.length(role) + len(TEXT) + 1, F.length(piece))).alias("text"),
        )

    return F.transform(pieces, one)


#: A placeholder in a formatted text: its kind and its number in the conversation.
PLACEHOLDER = r"<\|([A-Za-z0-9_]+):(\d+)\|>"


def read_messages(formatted: Column) -> Column:
    """The turns as array<struct<role, parts>>, a part being (kind, text, number): text or attachment."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: F.length(p) > 0)
    shape = "struct<kind:string,text:string,number:int>"

    def one(piece: Column) -> Column:
        role = F.substring_index(piece, TEXT, 1)
        content = piece.substr(F.length(role) + len(TEXT) + 1, F.length(piece))
        kinds = F.regexp_extract_all(content, F.lit(PLACEHOLDER), F.lit(1))
        numbers = F.regexp_extract_all(content, F.lit(PLACEHOLDER), F.lit(2))

        def both(text: Column, i: Column) -> Column:
            said = F.struct(F.lit("text"), unescape(text), F.lit(None)).cast(shape)
            mark = F.struct(F.get(kinds, i - 1), F.lit(None), F.get(numbers, i - 1)).cast(shape)
            return F.when(i > 0, F.array(mark, said)).otherwise(F.array(said))

        parts = F.flatten(F.transform(F.split(content, PLACEHOLDER), both))
        kept = F.filter(parts, lambda p: (p["kind"] != "text") | (F.length(p["text"]) > 0))
        return F.struct(
            unescape(role.substr(F.lit(len(TURN) + 1), F.length(role))).alias("role"), kept.alias("parts")
        )

    return F.transform(pieces, one)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    spans = F.transform(
        loss,
        lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
    return F.array_join(spans, "")


def digests(formatted: DataFrame) -> DataFrame:
    turns = read_turns(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = loss_text(F.col("formatted"), F.col("loss"))
    return formatted.select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
