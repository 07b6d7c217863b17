"""Chat formatting by a grammar round trip, in DataFrame functions only.

A turn is rendered as ``<s>[INST]role[/INST]text</s>`` and a conversation is its turns in order,
with nothing between. The parser is deterministic and strict: a conversation is a sequence of
such turns, and neither role nor text may hold one of the four control strings. Rendered
content is parsed again and compared with its source; content that does not come back is
escaped by one backslash inside each (possibly already escaped) control string, which the
parser takes away, and rendered once more. The whole conversation is then parsed again, and a
difference raises an error, so no row leaves without having made the round trip.

Defined results: a null role or text is empty; turns are ordered by turn, then role, then text,
nulls first, so ties and repeated rows keep a fixed order; a null conversation id is a
conversation of its own; an empty table gives no rows; other columns are ignored.

A conversation is one value of the output, so all its turns meet in one row; escaping and the
per-turn round trip happen before that, row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# characters of a block in which spans are looked for
BLOCK = 1 << 16

OPEN, MIDDLE, END = "<s>[INST]", "[/INST]", "</s>"
CONTROL = r"<s>|</s>|\[INST\]|\[/INST\]"
# the first character of a control string, backslashes of earlier escapes, the rest of it
ESCAPABLE = r"([<\[])(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPABLE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(END))


def _turn(piece: Column) -> Column:
    """One turn without its end mark: struct of role and text, null where the grammar fails."""
    parts = F.split(F.substring(piece, len(OPEN) + 1, 2**31 - 1), r"\[/INST\]", -1)
    role, text = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    right = (
        piece.startswith(OPEN)
        & (F.size(parts) == 2)
        & ~role.rlike(CONTROL)
        & ~text.rlike(CONTROL)
    )
    return F.when(right, F.struct(unescape(role).alias("role"), unescape(text).alias("text")))


def parse(formatted: Column) -> Column:
    """Array of turns; a piece that the grammar does not allow is null."""
    pieces = F.split(formatted, END, -1)
    inner = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    rest = F.element_at(pieces, -1)
    turns = F.transform(inner, _turn)
    return F.when(rest == "", turns).otherwise(F.concat(turns, F.array(_turn(rest))))


def format_conversations(
    conversations: DataFrame,
    *,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: key, formatted, recovered (array of role and text, parsed from
    `formatted`) and loss_spans (start and end in code points of each `learn` text in `formatted`)."""
    rows = conversations.select(
        F.col(key).alias("_key"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    # first round: as it is; only what does not come back is escaped
    raw = rows.withColumn("_back", parse(render(F.col("_role"), F.col("_text"))))
    source = F.struct(F.col("_role").alias("role"), F.col("_text").alias("text"))
    clean = F.coalesce((F.size("_back") == 1) & (F.get("_back", F.lit(0)) == source), F.lit(False))
    written = raw.select(
        "_key",
        "_turn",
        "_role",
        "_text",
        F.when(clean, F.col("_role")).otherwise(escape(F.col("_role"))).alias("_wrole"),
        F.when(clean, F.col("_text")).otherwise(escape(F.col("_text"))).alias("_wtext"),
    )
    before = Window.partitionBy("_key").orderBy("_turn", "_role", "_text")
    placed = written.withColumn("_n", F.row_number().over(before)).withColumn(
        "_end", F.sum(F.length(render(F.col("_wrole"), F.col("_wtext")))).over(before.rowsBetween(Window.unboundedPreceding, 0))
    )
    until = F.col("_end") - len(END)
    turns = placed.groupBy("_key").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "_n",
                    source.alias("source"),
                    render(F.col("_wrole"), F.col("_wtext")).alias("piece"),
                    F.when(F.col("_role") == learn, F.struct((until - F.length("_wtext")).alias("start"), until.alias("end"))).alias("span"),
                )
            )
        ).alias("_turns")
    )
    formatted = turns.select(
        "_key",
        F.col("_turns.source").alias("_source"),
        F.array_compact(F.col("_turns.span")).alias("loss_spans"),
        F.array_join(F.col("_turns.piece"), "").alias("formatted"),
    ).withColumn("recovered", parse(F.col("formatted")))
    same = F.coalesce(F.col("recovered") == F.col("_source"), F.lit(False))
    return formatted.select(
        F.col("_key").alias(key),
        F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation did not make the round trip")).cast("string")).alias("formatted"),
        "recovered",
        "loss_spans",
    )


def masked_texts(formatted: str = "formatted", spans: str = "loss_spans") -> tuple[Column, Column]:
    """The output in blocks, to be kept as `_blocks`, and the array of the texts under the loss mask: cut out
    of these at the spans, then unescaped.

    The output is cut in blocks first, so that a span of a long conversation is looked for in the
    blocks it touches and not from the first character on."""
    whole = F.col(formatted)
    starts = F.sequence(F.lit(0), F.greatest(F.length(whole) - 1, F.lit(0)), F.lit(BLOCK))
    blocks = F.transform(starts, lambda at: F.substr(whole, at + 1, F.lit(BLOCK)))

    def cut_out(span: Column) -> Column:
        first = F.floor(span["start"] / BLOCK).cast("int")
        last = F.floor(span["end"] / BLOCK).cast("int")
        near = F.array_join(F.slice("_blocks", first + 1, last - first + 1), "")
        return unescape(F.substr(near, (span["start"] - first * BLOCK + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

    return blocks, F.transform(spans, cut_out)


def digest(formatted: DataFrame, *, key: str = "conv_id") -> DataFrame:
    """Counts and checksums of what is read back from each formatted conversation: the turns by the
    parser, the learned text by the loss mask."""
    lines = F.transform("recovered", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    blocks, texts = masked_texts()
    cut = formatted.withColumn("_blocks", blocks).withColumn("_learned", F.array_join(texts, ""))
    return cut.select(
        F.col(key),
        F.size("recovered").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("_learned").cast("long").alias("loss_chars"),
        F.sha2("_learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
