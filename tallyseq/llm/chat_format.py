"""Chat formatting: typed content parts become one template text with a loss mask and attachments.

A visitor turns each content part into text: adjacent text parts are joined and escaped as one, image,
audio and document parts become an ordered placeholder, and their reference and expanded token count are
recorded in order. Parts of another kind become a placeholder of their own without tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The schema of one content part. Sizes not used by a kind stay null.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Control strings of the template and of common other ones. Inside texts each gets a backslash after
#: its first character, and a backslash is doubled, so `\\x` always reads back as `x`.
CONTROLS = ("<|", "</s>", "<s>", "[INST]", "[/INST]")
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OTHER = "<|attachment|>"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A content part that holds plain text; null counts as empty."""
    return F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )


def join_texts(parts: Column) -> Column:
    """Parts with runs of text parts made one, so that no control string can form where two meet.

    Null parts, and null parts arrays, count as nothing.
    """
    none = F.array().cast(f"array<{PART}>")

    def add(done: Column, p: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = text_part(F.concat(last["text"], F.coalesce(p["text"], F.lit(""))))
        own = F.when(p["kind"] == "text", text_part(p["text"])).otherwise(p)
        run = (F.size(done) > 0) & (last["kind"] == "text") & (p["kind"] == "text")
        return F.when(run, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(own)))

    return F.aggregate(F.filter(F.coalesce(parts, none), lambda p: p.isNotNull()), none, add)


def visit(part: Column, patch: int, audio_rate: int, page_tokens: int) -> Column:
    """One part -> struct(out, kind, ref, tokens). Null sizes and kinds not known: no tokens."""
    kind, none = part["kind"], F.lit(0).cast("bigint")
    tiles = F.ceil(part["width"] / patch) * F.ceil(part["height"] / patch)
    tokens = (
        F.when(kind == "image", tiles)
        .when(kind == "audio", F.ceil(part["seconds"] * audio_rate))
        .when(kind == "document", part["pages"].cast("bigint") * page_tokens)
    )
    out = F.when(kind == "text", escape(F.coalesce(part["text"], F.lit(""))))
    for name, mark in PLACEHOLDERS.items():
        out = out.when(kind == name, F.lit(mark))
    return F.struct(
        out.otherwise(F.lit(OTHER)).alias("out"), kind.alias("kind"), part["ref"].alias("ref"),
        F.coalesce(tokens.cast("bigint"), none).alias("tokens"),
    )


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
    loss_role: str = "assistant", patch: int = 14, audio_rate: int = 25, page_tokens: int = 1024,
) -> DataFrame:
    """(conv, formatted, n_turns, loss_spans, attachments, attachment_tokens), one row per conversation.

    `parts` is an array of PART; a null array or element counts as nothing, a null role as empty. A part of
    a null or unknown kind is an attachment too, with the placeholder OTHER and no tokens. Turns
    go by number (null first), then role, then rendered text, so ties and repeated rows have one
    order; repeated rows stay. loss_spans holds [start, end) in code points of the bodies of loss_role.
    The n-th placeholder in the text belongs to the n-th attachment. Rows with a null id form one
    conversation of their own. An empty input gives an empty result.

    Turns are rendered where they are read; offsets come from a running sum, and the group by
    conversation reuses its partitioning, so there is one shuffle. A conversation is one output value,
    so its turns meet in one task.
    """
    seen = turns.select(
        F.col(conv).alias("c"), F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit("")).alias("r"),
        F.transform(join_texts(F.col(parts)), lambda p: visit(p, patch, audio_rate, page_tokens)).alias("p"),
    )
    seen = seen.select(
        "c", "t", (F.col("r") == loss_role).alias("loss"),
        F.concat(F.lit(TURN), escape(F.col("r")), F.lit(BODY)).alias("head"),
        F.array_join(F.transform("p", lambda x: x["out"]), "").alias("body"),
        F.transform(F.filter("p", lambda x: x["kind"].isNull() | (x["kind"] != "text")), lambda x: x.dropFields("out")).alias("attached"),
    )
    seen = seen.select(
        "c", "t", "loss", "attached", F.char_length("head").alias("before"), F.char_length("body").alias("inside"),
        F.concat("head", "body", F.lit(END)).alias("out"),
    )
    order = Window.partitionBy("c").orderBy(F.col("t").asc_nulls_first(), "out")
    placed = seen.withColumns({
        "no": F.row_number().over(order),
        "at": F.sum(F.char_length("out").cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.char_length("out"),
    })
    row = F.struct("no", "out", "loss", (F.col("at") + F.col("before")).alias("start"), (F.col("at") + F.col("before") + F.col("inside")).alias("end"), "attached")
    chat = placed.groupBy("c").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return chat.select(
        F.col("c").alias(conv),
        F.array_join(F.transform("rows", lambda x: x["out"]), "").alias("formatted"),
        F.size("rows").cast("bigint").alias("n_turns"),
        F.transform(F.filter("rows", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("loss_spans"),
        F.flatten(F.transform("rows", lambda x: x["attached"])).alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda a, x: a + x["tokens"]))


def _read(row: dict) -> tuple:
    import hashlib
    import re

    text, plain = row["formatted"], lambda s: re.sub(r"\\(.)", r"\1", s, flags=re.S)
    turns = [t.partition(BODY) for t in text.split(END)[:-1]]
    whole = "".join(f"{plain(head[len(TURN):])}\n{plain(body)}\n" for head, _, body in turns)
    loss = "".join(plain(text[s["start"]:s["end"]]) for s in row["loss_spans"])
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), digest(whole), len(loss), digest(loss), len(text)


def read_back(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Parse formatted texts again: turns and loss text are recovered from the output alone.

    Returns (conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).
    """
    import pyarrow as pa

    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def batches(it):
        for b in it:
            rows = [_read(r) for r in b.select(["formatted", "loss_spans"]).to_pylist()]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], [conv, *names])

    kind = chats.schema[conv].dataType.simpleString()
    out = f"`{conv}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return chats.select(conv, "formatted", "loss_spans").mapInArrow(batches, out)
