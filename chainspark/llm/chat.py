"""Chat formatting with typed content parts, in DataFrame functions only.

A message holds an array of parts (text, image, audio, document). Each part is visited in order
and becomes text: text parts are escaped, the others become a placeholder `[kind:index]`, the kind escaped
as well, and an attachment record with the number of tokens the placeholder stands for.

Template: every turn is `<s>` role newline content `</s>`. Inside roles and texts no `<`, `[` or
single backslash is left: backslash becomes `\\e`, `<` becomes `\\l`, `[` becomes `\\b`. So no
control string of this template, nor of another that begins with these signs, survives in a text, a role
or a kind (where `]` becomes `\\k` and `:` becomes `\\c` too), and a `[` is a placeholder's, never a text's.
`parsed_turns` gives back exactly what went in: roles, text, and the parts in order, so a text `[image:0]`
and an image are told apart (neighbouring text parts are one, empty ones none).

Loss mask: for each assistant turn the text parts only, as (start, length) code points of the
formatted conversation; role header, placeholders and `</s>` are outside.

Edge cases: null text or null parts count as empty; a null role is empty; the rows without a conv_id
are one conversation, null; turns sort by number with nulls first, ties by role, then by content, and
repeated rows stay; an empty table gives an empty result; further columns are ignored. A
conversation becomes one string, so it has to fit in a row (2 GB), as any formatted chat does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BEGIN, END = "<s>", "</s>"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens a placeholder expands to: image by 14 x 14 pixel patches, audio by frames a second, document by page.
PATCH, FRAMES, PAGE_TOKENS = 14, 25, 512


def escaped(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\e"))
    return F.replace(F.replace(c, F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def escaped_role(c: Column) -> Column:
    """As `escaped`, and a newline, which ends the role, becomes `\\n`."""
    return F.replace(escaped(c), F.lit("\n"), F.lit("\\n"))


def unescaped_role(c: Column) -> Column:
    return unescaped(F.replace(c, F.lit("\\n"), F.lit("\n")))


def escaped_kind(c: Column) -> Column:
    """As `escaped`, and the signs that end a placeholder's parts become `\\k` and `\\c`."""
    return F.replace(F.replace(escaped(c), F.lit("]"), F.lit("\\k")), F.lit(":"), F.lit("\\c"))


def unescaped_kind(c: Column) -> Column:
    return unescaped(F.replace(F.replace(c, F.lit("\\c"), F.lit(":")), F.lit("\\k"), F.lit("]")))


def unescaped(c: Column) -> Column:
    c = F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))
    return F.replace(c, F.lit("\\e"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """A single text part, for tables that hold plain texts."""
    null = F.lit(None)
    return F.array(
        F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), null.cast("string").alias("ref"), null.cast("int").alias("width"), null.cast("int").alias("height"), null.cast("double").alias("seconds"), null.cast("int").alias("pages"))
    )


def part_tokens(p: Column) -> Column:
    side = lambda c: F.ceil(F.greatest(F.coalesce(c, F.lit(PATCH)), F.lit(1)) / PATCH)
    return (
        F.when(p["kind"] == "image", side(p["width"]) * side(p["height"]))
        .when(p["kind"] == "audio", F.ceil(F.greatest(F.coalesce(p["seconds"], F.lit(0.0)), F.lit(0.0)) * FRAMES))
        .when(p["kind"] == "document", F.greatest(F.coalesce(p["pages"], F.lit(1)), F.lit(1)) * PAGE_TOKENS)
        .otherwise(F.lit(0))
        .cast("long")
    )


def _is_text(p: Column) -> Column:
    return F.coalesce(p["kind"] == "text", F.lit(True))


def _pieces(parts: Column, before: Column) -> Column:
    """The parts as array<struct<pos, s, plain>> in order; placeholders count on from `before`.

    Attachments are numbered by their place among attachments, then both kinds are sorted together.
    """
    placed = F.transform(parts, lambda p, i: F.struct(i.alias("pos"), p.alias("p")))
    texts = F.transform(F.filter(placed, lambda x: _is_text(x["p"])), lambda x: F.struct(x["pos"].alias("pos"), escaped(F.coalesce(x["p"]["text"], F.lit(""))).alias("s"), F.lit(True).alias("plain")))
    name = lambda x, i: F.concat(F.lit("["), escaped_kind(x["p"]["kind"]), F.lit(":"), (before + i).cast("string"), F.lit("]"))
    media = F.transform(F.filter(placed, lambda x: ~_is_text(x["p"])), lambda x, i: F.struct(x["pos"].alias("pos"), name(x, i).alias("s"), F.lit(False).alias("plain")))
    return F.sort_array(F.concat(texts, media))


def format_chats(messages: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, loss, attachments, expanded_tokens) from (conv_id, turn, role, parts).

    `loss` is array<struct<start, length>> (start from 0, code points of `formatted`);
    `attachments` is array<struct<index, kind, ref, turn, tokens>> in reading order. The turns of a
    conversation meet once, in one shuffle by conv_id. Attachments and code points of earlier turns
    are running sums over the sorted turns, so the work grows with the number of turns alone.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"), F.monotonically_increasing_id().alias("row"))
    turns = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "parts", "row")
    earlier = turns.rowsBetween(Window.unboundedPreceding, -1)
    media = F.filter("parts", lambda p: ~_is_text(p))
    rows = rows.select("*", F.row_number().over(turns).alias("nth"), F.coalesce(F.sum(F.size(media)).over(earlier), F.lit(0)).alias("before"))
    head = F.concat(F.lit(BEGIN), escaped_role(F.col("role")), F.lit("\n"))
    rows = rows.withColumn("pieces", _pieces(F.col("parts"), F.col("before"))).withColumn("shown", F.concat(head, F.array_join(F.transform("pieces", lambda p: p["s"]), ""), F.lit(END)))
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("shown")).over(earlier), F.lit(0)) + F.length(head))
    # spans of this turn's text parts: what a message of its own parts holds, a short list
    spans = "array<struct<start:bigint,length:bigint>>"
    zero = F.struct(F.col("at").cast("long").alias("at"), F.array().cast(spans).alias("out"))
    step = lambda a, p: F.struct(
        (a["at"] + F.length(p["s"])).cast("long").alias("at"),
        F.when(p["plain"], F.concat(a["out"], F.array(F.struct(a["at"].alias("start"), F.length(p["s"]).cast("long").alias("length"))))).otherwise(a["out"]).alias("out"),
    )
    loss = F.when(F.col("role") == "assistant", F.aggregate("pieces", zero, step)["out"]).otherwise(F.array().cast(spans))
    found = F.transform(media, lambda p, i: F.struct((F.col("before") + i).cast("int").alias("index"), p["kind"].alias("kind"), p["ref"].alias("ref"), F.col("turn").alias("turn"), part_tokens(p).alias("tokens")))
    shown = F.struct("nth", "shown", loss.alias("loss"), found.alias("found"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(shown)).alias("turns"))
    attachments = F.flatten(F.transform("turns", lambda t: t["found"]))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
        F.flatten(F.transform("turns", lambda t: t["loss"])).alias("loss"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def parsed_turns(formatted: Column) -> Column:
    """array<struct<role, text, parts>> read back from a formatted conversation.

    `text` is that of all text parts; `parts` is array<struct<kind, text, index>>, where an attachment has
    its index and no text.
    """
    rows = F.split(formatted, END)
    rows = F.slice(rows, 1, F.size(rows) - 1)
    body = lambda t: F.substring(t, len(BEGIN) + 1, 2**31 - 1)

    def turn(t: Column) -> Column:
        # what follows a bracket is kind, index and the text after them
        pieces = F.split(_after(body(t), "\n"), "\\[")
        texts = F.transform(pieces, lambda s, i: F.when(i == 0, s).otherwise(_after(s, "]")))
        return F.struct(unescaped_role(F.substring_index(body(t), "\n", 1)).alias("role"), unescaped(F.array_join(texts, "")).alias("text"), _parts(pieces).alias("parts"))

    return F.transform(rows, turn)


def _parts(pieces: Column) -> Column:
    """The parts of a turn's content, which was split at `[`."""
    text = lambda s: F.struct(F.lit("text").alias("kind"), unescaped(s).alias("text"), F.lit(None).cast("int").alias("index"))
    media = lambda s: F.struct(unescaped_kind(F.substring_index(s, ":", 1)).alias("kind"), F.lit(None).cast("string").alias("text"), F.substring_index(F.substring_index(s, "]", 1), ":", -1).cast("int").alias("index"))
    rest = F.flatten(F.transform(F.slice(pieces, 2, F.size(pieces)), lambda s: F.array(media(s), text(_after(s, "]")))))
    return F.filter(F.concat(F.array(text(F.get(pieces, 0))), rest), lambda p: p["text"].isNull() | (p["text"] != ""))


def _after(c: Column, sep: str) -> Column:
    return c.substr(F.instr(c, sep) + 1, F.length(c))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return unescaped(F.array_join(F.transform(loss, lambda m: formatted.substr((m["start"] + 1).cast("int"), m["length"].cast("int"))), ""))
