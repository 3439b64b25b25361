"""Chat formatting with a round trip through the template's own grammar. Built-in functions only.

Grammar of a rendered conversation, on which `parse` works without choices:

    conversation := turn*
    turn         := "<|im_start|>" role ["<|escaped|>"] "\\n" body "<|im_end|>" "\\n"

A role has no "<", "%" or line end (they are percent-coded). A body holds none of the three control strings. In an
escaped body every "<", backslashes, "|" has one backslash more than the text, so no control string can remain in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END, MARK = "<|im_start|>", "<|im_end|>", "<|escaped|>"
_ROLE_CODES = (("%", "%25"), ("<", "%3C"), ("\n", "%0A"))


def _holds_control(text: Column) -> Column:
    return text.contains(START) | text.contains(END) | text.contains(MARK)


def _role_out(role: Column) -> Column:
    for plain, code in _ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _role_back(role: Column) -> Column:
    for plain, code in reversed(_ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def _escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def render(turns: Column, escaped) -> Column:
    """Text of an array of (role, text); `escaped(text)` says which turns are escaped."""

    def one(turn: Column) -> Column:
        mark = escaped(turn["text"])
        body = F.when(mark, _escape(turn["text"])).otherwise(turn["text"])
        return F.concat(F.lit(START), _role_out(turn["role"]), F.when(mark, MARK).otherwise(""), F.lit("\n"), body, F.lit(f"{END}\n"))

    return F.array_join(F.transform(turns, one), "")


def parse(rendered: Column) -> Column:
    """Array of (role, text) that the grammar reads from a text; null in place of what is no turn."""

    def one(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        rest = F.substring(part, F.length(head) + 2, F.length(part))
        body = F.substring(rest, F.lit(1), F.length(rest) - len(END) - 1)
        mark = F.endswith(head, F.lit(MARK))
        role = F.when(mark, F.substring(head, F.lit(1), F.length(head) - len(MARK))).otherwise(head)
        turn = F.struct(_role_back(role).alias("role"), F.when(mark, _unescape(body)).otherwise(body).alias("text"))
        good = F.endswith(rest, F.lit(f"{END}\n")) & ~_holds_control(body) & ~role.contains("<")
        return F.when(good, turn)

    parts = F.split(rendered, r"<\|im_start\|>")
    return F.when(parts[0] == "", F.transform(F.slice(parts, F.lit(2), F.size(parts)), one))


def format_chat(turns: DataFrame) -> DataFrame:
    """One row per conv_id: formatted, the turns (role, text, loss) read back from it, and whether any was escaped.

    A conversation is first rendered as it is and read back. Where the turns read differ from the source, the turns
    that hold control strings are escaped, and it is read back again; a conversation that still differs stops the job.
    `loss` marks assistant turns.

    Turns are ordered by (turn, role, text), null turn numbers first, so ties and repeated rows have one order; each row
    is a turn. Null role or text counts as empty; null conv_id is a conversation of its own. Other columns are ignored,
    an empty table gives no rows. A conversation is one value: its turns have to fit in one row.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    rows = turns.select("conv_id", F.struct(F.col("turn"), text("role"), text("text")).alias("row"))
    source = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    source = source.select("conv_id", F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("source"))
    tried = source.withColumn("plain", render(F.col("source"), lambda t: F.lit(False)))
    tried = tried.withColumn("fits", F.coalesce(parse(F.col("plain")).eqNullSafe(F.col("source")), F.lit(False)))
    chosen = tried.withColumn("formatted", F.when(F.col("fits"), F.col("plain")).otherwise(render(F.col("source"), _holds_control)))
    read = chosen.withColumn("read", parse(F.col("formatted")))
    same = F.when(F.col("read").eqNullSafe(F.col("source")), F.col("read"))
    checked = read.withColumn("read", F.coalesce(same, F.raise_error(F.lit("a conversation does not survive its template"))))
    loss = F.transform("read", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), (t["role"] == "assistant").alias("loss")))
    return checked.select("conv_id", "formatted", loss.alias("turns"), (~F.col("fits")).alias("escaped"))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and hashes of `format_chat`'s turns: all turns, and the text under the loss mask."""
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
