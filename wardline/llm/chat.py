r"""Chat formatting by a grammar round trip (operator 11); DataFrame functions only.

The template puts each turn between marks that say its role: ``[INST] user [/INST]``, ``[SYS] system [/SYS]``,
``<s>assistant</s>`` and, for any other role, ``[ROLE]name[TEXT]text[/ROLE]``. The grammar is a sequence of such
turns, and the parser is deterministic: it cuts behind every closing mark, and each cut must be one whole turn whose
name and text hold no mark. A mark with backslashes behind its bracket is text, and loses one of them.

Round trip: a conversation is rendered as it stands and parsed. Turns that come back unlike the source are
escaped (each mark in them, backslashed or not, gets one backslash more) and the text is rendered and parsed again. If any turn
still differs, every turn is escaped, which cannot differ: escaping raises every count of backslashes by one, so no
bare mark is left, and marks cannot arise across a boundary, as each has one bracket, its first character. The text written
has been compared with the source; a difference would raise an error.

Long conversations: rendering, parsing and comparing are done for parts of a conversation, ``PART_TURNS`` values of ``turn``
each, which are rows of the output (``conv_id, part``); a conversation's text is its parts in order. So a
conversation with very many turns is spread over tasks. Only the digests of the query need its whole text in one cell.

Turns stand in the order of ``turn``, then role, then text, nulls first; repeated rows are turns of their own. Null text: empty.
Null role: the empty name. Null ``conv_id``: one conversation. Null ``turn``: a part of its own, before all others. An
empty table gives no rows (the added conversation alone in the query). Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch

#: Values of ``turn`` that are formatted together.
PART_TURNS = 64

#: Opening and closing text of the turns of known roles.
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")

#: A mark, its backslashes in the second group.
MARK = r"([\[<]/?)(\\*)((?:INST|SYS|ROLE|TEXT)\]|s>)"
BARE = MARK.replace(r"(\\*)", "")
ESCAPED = MARK.replace(r"(\\*)", r"\\(\\*)")
BEHIND_CLOSING = r"(?<=\[/INST\]|\[/SYS\]|\[/ROLE\]|</s>)"

#: Texts of the conversation that the query adds.
PROBE = "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, MARK, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _opening(role: Column, name: Column) -> Column:
    out = F.concat(F.lit(OTHER[0]), name, F.lit(OTHER[1]))
    for known, (opening, _) in MARKS.items():
        out = F.when(role == known, opening).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit(OTHER[2])
    for known, (_, closing) in MARKS.items():
        out = F.when(role == known, closing).otherwise(out)
    return out


def _rendered(turns: Column, flags: Column) -> Column:
    """Per turn its opening, its text and its closing; texts and names are escaped where the flag is set."""

    def one(turn: Column, flag: Column) -> Column:
        name = F.when(flag, escape(turn["role"])).otherwise(turn["role"])
        text = F.when(flag, escape(turn["text"])).otherwise(turn["text"])
        return F.struct(_opening(turn["role"], name).alias("opening"), text.alias("text"), _closing(turn["role"]).alias("closing"))

    return F.zip_with(turns, flags, one)


def _joined(rendered: Column) -> Column:
    return F.array_join(F.transform(rendered, lambda t: F.concat(t["opening"], t["text"], t["closing"])), "")


def _parsed_turn(piece: Column) -> Column:
    """``role, text`` of a piece that is one whole turn; null where it is not."""

    def inner(opening: str, closing: str) -> Column:
        return F.substring(piece, F.lit(len(opening) + 1), F.length(piece) - F.lit(len(opening) + len(closing)))

    def turn(role: Column, text: Column) -> Column:
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    body = inner(OTHER[0], OTHER[2])
    name, text = F.substring_index(body, OTHER[1], 1), F.substring(body, F.instr(body, OTHER[1]) + F.lit(len(OTHER[1])), F.length(body))
    fits = piece.startswith(OTHER[0]) & piece.endswith(OTHER[2]) & body.contains(OTHER[1]) & ~F.rlike(name, F.lit(BARE)) & ~F.rlike(text, F.lit(BARE))
    # A known role never stands in the form of the others.
    fits = fits & ~unescape(name).isin(*MARKS)
    out = F.when(fits, turn(name, text))
    for role, (opening, closing) in MARKS.items():
        body = inner(opening, closing)
        whole = piece.startswith(opening) & piece.endswith(closing) & (F.length(piece) >= len(opening) + len(closing))
        out = F.when(whole & ~F.rlike(body, F.lit(BARE)), turn(F.lit(role), body)).otherwise(out)
    return out


def parse(formatted: Column) -> Column:
    """The turns of a formatted text, ``role, text``; null in place of what is no turn of the grammar."""
    return F.transform(F.array_remove(F.split(formatted, BEHIND_CLOSING, -1), ""), _parsed_turn)


def _differs(turns: Column, parsed: Column) -> Column:
    """Per turn whether it came back unlike the source; pieces beyond the turns differ too."""
    return F.zip_with(turns, parsed, lambda t, p: ~t.eqNullSafe(p))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """The frame with columns that are computed once, however often they are used: projections are not merged across a generator."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def format_chats(
    chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, part, n_turns, formatted, loss_spans, rounds``: formatted texts, one row per part.

    ``loss_spans`` are the assistant's texts as ``start`` (from 0) and ``length`` in code points of ``formatted``;
    ``rounds`` says how many renderings it took until the parsed turns were the source's.
    """
    read = chats.select(
        F.col(conv_col).alias("conv_id"),
        F.floor(F.col(turn_col) / PART_TURNS).alias("part"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    # A part has PART_TURNS turns unless a turn is repeated.
    parts = read.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("t")).alias("t"))
    parts = parts.withColumn("turns", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))).drop("t")
    turns = F.col("turns")

    def rendered(df: DataFrame, n: int, flags: Column, due: Column) -> DataFrame:
        """Where due, the rendering with the flagged turns escaped, what differs in it, and whether anything does."""
        df = _once(df, **{f"made{n}": F.when(due, _rendered(turns, flags))})
        df = _once(df, **{f"text{n}": F.when(due, _joined(F.col(f"made{n}")))})
        df = _once(df, **{f"wrong{n}": F.when(due, _differs(turns, parse(F.col(f"text{n}"))))})
        return _once(df, **{f"bad{n}": F.exists(f"wrong{n}", lambda x: x)})

    found = rendered(parts, 0, F.transform(turns, lambda _: F.lit(False)), F.lit(True))
    found = rendered(found, 1, F.slice("wrong0", F.lit(1), F.size(turns)), F.col("bad0"))
    found = rendered(found, 2, F.transform(turns, lambda _: F.lit(True)), F.coalesce("bad1", F.lit(False)))
    failed = F.raise_error(F.lit("a formatted conversation does not parse into its source"))
    found = found.select(
        "conv_id",
        "part",
        "turns",
        F.when(~F.col("bad0"), F.col("made0")).when(~F.col("bad1"), F.col("made1")).otherwise(F.col("made2")).alias("made"),
        F.when(~F.col("bad0"), F.col("text0"))
        .when(~F.col("bad1"), F.col("text1"))
        .when(~F.col("bad2"), F.col("text2"))
        .otherwise(failed.cast("string"))
        .alias("formatted"),
        F.when(~F.col("bad0"), 1).when(~F.col("bad1"), 2).otherwise(3).alias("rounds"),
    )
    # Where each turn's text begins: one sum over the turns, the place reached and the spans so far.
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(so_far: Column, turn: Column) -> Column:
        begins = so_far["at"] + F.length(turn["opening"])
        span = F.struct(begins.alias("start"), F.length(turn["text"]).cast("long").alias("length"))
        spans = F.when(turn["opening"] == MARKS["assistant"][0], F.concat(so_far["spans"], F.array(span))).otherwise(so_far["spans"])
        return F.struct((begins + F.length(turn["text"]) + F.length(turn["closing"])).alias("at"), spans.alias("spans"))

    spans = F.aggregate("made", start, step, lambda x: x["spans"])
    return found.select("conv_id", "part", F.size("turns").alias("n_turns"), "formatted", spans.alias("loss_spans"), "rounds")


def write_chats(chats: DataFrame, scratch: Scratch, **columns: str) -> DataFrame:
    """The formatted conversations, written as Parquet and read back."""
    return scratch.table(format_chats(chats, **columns), "formatted")


def with_probe(chats: DataFrame) -> DataFrame:
    """The table's conversations and one more, whose texts are made of marks."""
    row = lambda turn, role: F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(PROBE).alias("text"))
    added = chats.sparkSession.range(1).select(F.inline(F.array(row(0, "user"), row(1, "assistant"))))
    return chats.select("conv_id", "turn", "role", "text").unionByName(added)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what a reader gets from the formatted text alone, by the parser and the loss mask."""
    formatted, turns = _once(formatted, turns=parse(F.col("formatted"))), F.col("turns")
    whole = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    part = F.struct("part", whole.alias("whole"), F.array_join(loss, "").alias("loss"))
    read = formatted.select("conv_id", F.size(turns).alias("n"), F.length("formatted").alias("chars"), part.alias("p"))
    each = read.groupBy("conv_id").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sort_array(F.collect_list("p")).alias("p"))
    both = each.select("conv_id", "n", "chars", F.array_join("p.whole", "").alias("whole"), F.array_join("p.loss", "").alias("loss"))
    return both.select(
        "conv_id",
        F.col("n").alias("n_turns"),
        F.sha2("whole", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )
