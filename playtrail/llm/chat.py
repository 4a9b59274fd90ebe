"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted. Adjacent turns of one
role become one block by a fold over the sorted array; blocks are concatenated:

    <|user|>first text<+>second text<|end|>
    <|assistant|>answer<|end|>

``<`` never stands in an escaped text, so every ``<`` of the output begins one of
the template's marks, and the output can be read back without its source. ``<+>``
parts the turns of a block. The escapes are ``\\b`` for a backslash, ``\\l`` for
``<`` and ``\\p`` for ``|`` (which ends a role's name).

The loss mask is the list of character spans in the output that hold assistant
text: the spans of turns, without the marks.

Defined results: null text and null role count as empty; ties of the turn number
are ordered by role and text, a null number comes first; repeated rows are
repeated turns; a null conversation id is a conversation. One conversation is one
row of output by nature, so its turns do meet in one task; conversations are
otherwise dealt evenly. Other columns are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"
JOIN = "<+>"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("\\l")), F.lit("|"), F.lit("\\p"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\p"), F.lit("|")), F.lit("\\l"), F.lit("<"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def merge_turns(turns: Column) -> Column:
    """Blocks (role, texts) of adjacent turns of one role, by one aggregation of the array."""
    empty = F.expr("cast(array() as array<struct<role:string,texts:array<string>>>)")

    def add(blocks: Column, turn: Column) -> Column:
        last = F.try_element_at(blocks, F.lit(-1))
        grown = F.struct(
            last["role"].alias("role"), F.array_append(last["texts"], turn["text"]).alias("texts")
        )
        fresh = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        return F.when(
            last["role"] == turn["role"],
            F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(grown)),
        ).otherwise(F.concat(blocks, F.array(fresh)))

    return F.aggregate(turns, empty, add)


def format_blocks(blocks: Column) -> Column:
    def one(block: Column) -> Column:
        texts = F.array_join(F.transform(block["texts"], escape), JOIN)
        return F.concat(F.lit("<|"), escape(block["role"]), F.lit("|>"), texts, F.lit(END))

    return F.array_join(F.transform(blocks, one), "")


def formatted(
    turns: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text"
) -> DataFrame:
    """One row per conversation: id, formatted text, loss mask (spans from character 0)."""
    fields = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    sorted_turns = F.sort_array(F.collect_list("turn_"))
    whole = (
        turns.select(F.col(id_col).alias("id"), fields.alias("turn_"))
        .groupBy("id")
        .agg(merge_turns(sorted_turns).alias("blocks"))
        .select("id", format_blocks(F.col("blocks")).alias("formatted"))
    )
    return whole.withColumn("loss_mask", loss_mask(F.col("formatted")))


def read_blocks(text: Column) -> Column:
    """The blocks of a formatted text, still escaped: array of (role, texts)."""
    parts = F.filter(F.split(text, r"<\|end\|>\n", -1), lambda part: part != "")

    def one(part: Column) -> Column:
        return F.struct(
            F.substring_index(F.substr(part, F.lit(3)), "|>", 1).alias("role"),
            F.split(_body(part), r"<\+>", -1).alias("texts"),
        )

    return F.transform(parts, one)


def _body(part: Column) -> Column:
    return F.substr(part, F.instr(part, "|>") + 2)


def read_turns(text: Column) -> Column:
    """The turns of a formatted text as they were: array of (role, text)."""
    return F.flatten(
        F.transform(
            read_blocks(text),
            lambda block: F.transform(
                block["texts"],
                lambda x: F.struct(unescape(block["role"]).alias("role"), unescape(x).alias("text")),
            ),
        )
    )


def loss_mask(text: Column, role: str = "assistant") -> Column:
    """Spans (start, end) of characters of the output that hold texts of ``role``."""
    start = F.expr(
        "cast(named_struct('at', 0, 'spans', array()) as "
        "struct<at:int,spans:array<struct<start:int,end:int>>>)"
    )

    def spans(state: Column, block: Column) -> Column:
        head = state["at"] + F.length(block["role"]) + F.lit(4)

        def turn(inner: Column, x: Column) -> Column:
            span = F.struct(inner["at"].alias("start"), (inner["at"] + F.length(x)).alias("end"))
            return F.struct(
                (inner["at"] + F.length(x) + F.lit(len(JOIN))).alias("at"),
                F.when(block["role"] == escape(F.lit(role)), F.array_append(inner["spans"], span))
                .otherwise(inner["spans"])
                .alias("spans"),
            )

        done = F.aggregate(
            block["texts"], F.struct(head.alias("at"), state["spans"].alias("spans")), turn
        )
        after = done["at"] - F.lit(len(JOIN)) + F.lit(len(END))
        return F.struct(after.alias("at"), done["spans"].alias("spans"))

    return F.aggregate(read_blocks(text), start, spans)["spans"]


def masked_text(text: Column, mask: Column) -> Column:
    """What the mask covers, unescaped and concatenated."""
    return F.array_join(
        F.transform(
            mask, lambda s: unescape(F.substr(text, s["start"] + 1, s["end"] - s["start"]))
        ),
        "",
    )
