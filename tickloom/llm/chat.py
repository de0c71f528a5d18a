"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted by turn (ties by role
and text), adjacent turns of one role merge into a run by array aggregation, and runs are
concatenated: ``<|im_start|>role``, a line break, the texts of the run with ``<|im_sep|>``
between them, ``<|im_end|>``, a line break.  Control strings are told by ``<`` and ``[``,
which texts and roles can't hold: a backslash, ``<`` and ``[`` are written as a
backslash and one of e, l and b (in roles a line break as a backslash and n), so no
text can look like a control string, of this or of other templates, and all are read
back unchanged.  The loss mask lists start and length, in code points, of each assistant
text.

Null text or role: empty.  Null turn: before the others.  Rows without conv_id are one
conversation without an id.  Repeated rows are turns of their own.  Empty tables give no
rows.  Extra columns are left out.  A conversation is one row of the result, so its turns
meet in one task; nothing larger does, and the time for it grows with its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BETWEEN, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
#: What is written for a character, the backslash first.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))


def escape(text: Column, escapes=ESCAPES) -> Column:
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


#: Lengths that are added up one after another before the sums of such blocks are.
BLOCK = 512


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where ``value`` is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _indexes(array: Column) -> Column:
    return F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(F.array().cast("array<int>"))


def _running(lengths: Column) -> Column:
    """What comes before each of the lengths, added up; by blocks, since an array is copied with each sum put on it."""

    def add(sums: Column, length: Column) -> Column:
        return F.concat(sums, F.array(F.element_at(sums, -1) + length))

    def within(start: Column, block: Column) -> Column:
        return F.slice(F.aggregate(block, F.array(start.cast("bigint")), add), F.lit(1), F.size(block))

    def summed(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda x, y: x + y))
        starts = F.aggregate(totals, F.array(F.lit(0).cast("bigint")), add)
        return _let(starts, lambda at: F.flatten(F.transform(blocks, lambda b, k: within(at[k], b))))

    def cut(of: Column) -> Column:
        count = F.ceil(F.size(of) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda k: F.slice(of, k * BLOCK + 1, F.lit(BLOCK)))
        return _let(blocks, summed)

    return _let(lengths, cut)


def _merged(turns: Column) -> Column:
    """Runs of adjacent turns of one role: slices between the places where the role changes."""

    def between(of: Column, starts: Column) -> Column:
        def run(start: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(of))
            return F.struct(of[start]["role"].alias("role"), F.transform(F.slice(of, start + 1, end - start), lambda t: t["text"]).alias("texts"))

        return F.transform(starts, run)

    def cut(of: Column) -> Column:
        starts = F.filter(_indexes(of), lambda i: (i == 0) | (F.get(of, i)["role"] != F.get(of, i - 1)["role"]))
        return _let(starts, lambda s: between(of, s))

    return _let(turns, cut)


def _pieces(run: Column) -> Column:
    """What is written for each text of a run: before it, itself, after it, and whether it is learned."""
    count = F.size(run["texts"])
    return F.transform(
        run["texts"],
        lambda text, i: F.struct(
            F.when(i == 0, F.concat(F.lit(OPEN), escape(run["role"], ROLE_ESCAPES), F.lit("\n"))).otherwise(F.lit(BETWEEN)).alias("before"),
            escape(text).alias("body"),
            F.when(i == count - 1, F.lit(CLOSE)).otherwise(F.lit("")).alias("after"),
            (run["role"] == LOSS_ROLE).alias("loss"),
        ),
    )


def _spans(pieces: Column) -> Column:
    """Where the learned bodies are."""

    def spans(of: Column, at: Column) -> Column:
        learned = F.filter(_indexes(of), lambda i: of[i]["loss"])
        place = lambda i: F.struct((at[i] + F.char_length(of[i]["before"])).alias("start"), F.char_length(of[i]["body"]).cast("bigint").alias("length"))
        return F.transform(learned, place)

    def cut(of: Column) -> Column:
        lengths = F.transform(of, lambda p: F.char_length(p["before"]) + F.char_length(p["body"]) + F.char_length(p["after"]))
        return _let(_running(lengths), lambda at: spans(of, at))

    return _let(pieces, cut)


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_mask) of rows (conv_id, turn, role, text)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def both(pieces: Column) -> Column:
        written = F.transform(pieces, lambda p: F.concat(p["before"], p["body"], p["after"]))
        return F.struct(F.array_join(written, "").alias("formatted"), _spans(pieces).alias("loss_mask"))

    pieces = F.flatten(F.transform(_merged(F.col("turns")), _pieces))
    return collected.select("conv_id", _let(pieces, both).alias("made")).select("conv_id", "made.*")


def _read_pieces(formatted: Column) -> Column:
    """Role, written text, and what is written before and after it, of each text of a formatted conversation."""
    runs = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda s: s != "")

    def pieces(role: Column, head: Column, texts: Column) -> Column:
        return F.transform(
            texts,
            lambda text, i: F.struct(
                role.alias("role"),
                text.alias("text"),
                F.when(i == 0, head).otherwise(len(BETWEEN)).alias("before"),
                F.when(i == F.size(texts) - 1, len(CLOSE)).otherwise(0).alias("after"),
            ),
        )

    def read(run: Column) -> Column:
        return _let(F.instr(run, "\n"), lambda head: _let(F.split(F.substr(run, head + 1), r"<\|im_sep\|>"), lambda texts: pieces(F.substr(run, F.lit(len(OPEN) + 1), head - len(OPEN) - 1), head, texts)))

    return F.flatten(F.transform(runs, read))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    return F.transform(_read_pieces(formatted), lambda p: F.struct(unescape(p["role"], ROLE_ESCAPES).alias("role"), unescape(p["text"]).alias("text")))


def read_loss(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, whose spans are whole texts.

    Texts and spans are put in one order by their places, so that a span comes right before its text.
    """

    def met(both: Column) -> Column:
        under = F.filter(_indexes(both), lambda i: (i > 0) & (both[i]["kind"] == 1) & (F.get(both, i - 1)["kind"] == 0) & (F.get(both, i - 1)["start"] == both[i]["start"]) & (F.get(both, i - 1)["length"] == both[i]["length"]))
        return F.array_join(F.transform(under, lambda i: unescape(both[i]["text"])), "")

    def placed(of: Column, at: Column) -> Column:
        texts = F.transform(of, lambda p, i: _entry(at[i] + p["before"], 1, F.char_length(p["text"]), p["text"]))
        spans = F.transform(mask, lambda m: _entry(m["start"], 0, m["length"], F.lit("")))
        return _let(F.array_sort(F.concat(texts, spans)), met)

    def cut(of: Column) -> Column:
        lengths = F.transform(of, lambda p: p["before"] + F.char_length(p["text"]) + p["after"])
        return _let(_running(lengths), lambda at: placed(of, at))

    return _let(_read_pieces(formatted), cut)


def _entry(start: Column, kind: int, length: Column, text: Column) -> Column:
    return F.struct(start.cast("bigint").alias("start"), F.lit(kind).alias("kind"), length.cast("bigint").alias("length"), text.alias("text"))


def digests(conversations: DataFrame) -> DataFrame:
    """What is read back from (conv_id, formatted, loss_mask)."""
    read = conversations.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
