r"""Conversations to training text that parses back to exactly the same turns.

Template, after one ``<s>``::

    system      [SYS] text [/SYS]
    user        [INST] text [/INST]
    assistant    text</s>                     (a space, the text, the end mark)
    any other   [ROLE]role[/ROLE] text [END]

Every turn is rendered as it is, read by the parser and compared with its source.  Where
that differs, or a control string shows that is not a mark of the template, its content
is escaped - a backslash goes after the bracket of every control string, also of one that
already has backslashes there - and the check runs again.  Content without conflicts
stays as it is.  The parser takes one backslash away again, so escaping is reversible.
The rendered conversation is then parsed as a whole and compared with all its turns.

Null text or role is empty; rows of a null conversation form one conversation; rows are
ordered by turn (nulls first), ties by role and text, and repeated rows are kept.  Other
columns are ignored.  An empty table gives none.  A conversation is one row of output,
so its turns are gathered in one place.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN = "<s>"
#: Opening and closing mark of each form; between the two of "role" stands the role itself.
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>"), "role": ("[ROLE]", "[/ROLE] ", " [END]")}
_NAMES = r"/?(?:s>|INST\]|SYS\]|ROLE\]|END\])"
CONTROL = rf"[<\[]{_NAMES}"
TURN = r"(?s)\[SYS\] .*? \[/SYS\]|\[INST\] .*? \[/INST\]|\[ROLE\].*?\[/ROLE\] .*? \[END\]| .*?</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*{_NAMES})", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*{_NAMES})", "$1$2")


def _render(role: Column, text: Column) -> Column:
    out = F.concat(F.lit(MARKS["role"][0]), role, F.lit(MARKS["role"][1]), text, F.lit(MARKS["role"][2]))
    for name in ("system", "user", "assistant"):
        out = F.when(role == name, F.concat(F.lit(MARKS[name][0]), text, F.lit(MARKS[name][1]))).otherwise(out)
    return out


def _inner(turn: Column, opening: str, closing: str) -> Column:
    return unescape(F.substring(turn, F.lit(len(opening) + 1), F.length(turn) - len(opening) - len(closing)))


def _read(turn: Column) -> Column:
    """role and text of one turn."""
    middle = F.instr(turn, MARKS["role"][1])
    out = F.struct(
        unescape(F.substring(turn, F.lit(len("[ROLE]") + 1), middle - len("[ROLE]") - 1)).alias("role"),
        unescape(F.substring(turn, middle + len("[/ROLE] "), F.length(turn) - middle - len("[/ROLE] ") - len(" [END]") + 1)).alias("text"))
    for name, test in (("assistant", turn.startswith(" ")), ("user", turn.startswith("[INST] ")), ("system", turn.startswith("[SYS] "))):
        out = F.when(test, F.struct(F.lit(name).alias("role"), _inner(turn, *MARKS[name]).alias("text"))).otherwise(out)
    return out


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a rendered conversation."""
    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), _read)


def _faithful(rendered: Column, role: Column, text: Column) -> Column:
    """Whether one rendered turn reads back as itself and shows no control strings but its own marks."""
    marks = F.when(role == "assistant", 1).when(role.isin("system", "user"), 2).otherwise(3)
    turns = parse(rendered)
    same = (F.size(turns) == 1) & (turns[0]["role"] == role) & (turns[0]["text"] == text)
    return F.when(F.regexp_count(rendered, F.lit(CONTROL)) == marks, same).otherwise(False)


def format_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans, n_escaped, faithful), one row per conversation.

    loss_spans are the code points [start, end) of formatted that hold assistant text;
    n_escaped counts turns that needed escaping; faithful says that formatted parses back
    to the source turns.
    """
    turns = rows.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    raw = _render(F.col("role"), F.col("text"))
    turns = turns.withColumn("raw", raw).withColumn("plain", _faithful(F.col("raw"), F.col("role"), F.col("text")))
    turns = turns.withColumn("part", F.when(F.col("plain"), F.col("raw")).otherwise(_render(escape(F.col("role")), escape(F.col("text")))))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    start = F.lit(len(BEGIN)) + F.coalesce(F.sum(F.length("part")).over(before), F.lit(0))
    loss = F.when(F.col("role") == "assistant", F.struct((start + 1).alias("start"), (start + F.length("part") - len("</s>")).alias("end")))
    turns = turns.withColumns({"loss": loss, "at": start})
    gathered = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "at", "part", "loss"))).alias("ts"),
        F.count(F.lit(1)).alias("n_turns"), F.sum(F.when(F.col("plain"), 0).otherwise(1)).alias("n_escaped"))
    out = gathered.select("conv_id", "n_turns", "n_escaped", F.concat(F.lit(BEGIN), F.array_join("ts.part", "")).alias("formatted"),
                          F.filter("ts.loss", lambda s: s.isNotNull()).alias("loss_spans"), F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    return out.select("conv_id", "n_turns", "formatted", "loss_spans", "n_escaped", (parse(F.col("formatted")) == F.col("source")).alias("faithful"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds turns (parsed from formatted) and loss_text (formatted under loss_spans, unescaped)."""
    spans = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumns({"turns": parse(F.col("formatted")), "loss_text": F.array_join(spans, "")})
