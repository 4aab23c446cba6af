"""Chat formatting with a grammar that is read back, in SQL functions alone.

    conversation := turn*
    turn         := "[INST] " role " [/INST]" text "</s>"

A turn whose plain rendering is not read back as it was, because its content holds control strings or
what looks like an escape, is rendered with its content escaped, which is reversible for any content.
The whole conversation is then parsed and compared with its source; should it differ, all its turns
are escaped. ``identical`` tells the outcome, and ``level`` how much was escaped: 0 nothing, 1 single
turns, 2 every turn.

The loss mask covers the text of assistant turns, without their marks.

Defined cases: a null or empty text is an empty text, a null role an empty role; turns are ordered by
``turn`` (null first), ties by role and text; repeated rows are repeated turns; rows whose ``conv_id`` is
null form one conversation; no rows give no conversations; further columns are ignored. A conversation
is one row of the result, so the longest one bounds a task's memory.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, END = "[INST] ", " [/INST]", "</s>"
# The escape character first: in escaped content it stands at the start of a code only.
CODES = {"&": "&a;", "</s>": "&e;", "<s>": "&b;", "[INST]": "&i;", "[/INST]": "&c;"}
LEARNED = "assistant"


def escaped(text: str) -> str:
    for plain, code in CODES.items():
        text = f"replace({text}, '{plain}', '{code}')"
    return text


def unescaped(text: str) -> str:
    for plain, code in reversed(CODES.items()):
        text = f"replace({text}, '{code}', '{plain}')"
    return text


def rendered(role: str, text: str) -> str:
    return f"concat('{OPEN}', {role}, '{CLOSE}', {text}, '{END}')"


def parsed(formatted: str) -> str:
    """The turns of a formatted conversation, null where one does not follow the grammar.

    A text ends at the first end mark, a role at the first close mark.
    """
    role = unescaped(f"substring(x, {len(OPEN) + 1}, locate('{CLOSE}', x) - {len(OPEN) + 1})")
    text = unescaped(f"substring(x, locate('{CLOSE}', x) + {len(CLOSE)})")
    turn = f"IF(startswith(x, '{OPEN}') AND locate('{CLOSE}', x) > {len(OPEN)}, struct({role} AS role, {text} AS text), NULL)"
    pieces = f"split({formatted}, '{END}', -1)"
    return f"transform(slice({pieces}, 1, size({pieces}) - 1), x -> {turn})"


def format_chats(rows: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), formatted, loss_spans (start from 0, length), level, identical."""
    turns = rows.selectExpr("conv_id", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text").selectExpr(
        "*", f"{escaped('role')} AS safe_role", f"{escaped('text')} AS safe_text",
        f"{parsed(rendered('role', 'text'))} <=> array(struct(role, text)) AS fits",
    )
    chosen = turns.selectExpr(
        "*", "IF(fits, role, safe_role) AS own_role", "IF(fits, text, safe_text) AS own_text"
    )
    marks = len(OPEN) + len(CLOSE) + len(END)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = chosen.withColumns(
        {
            "at": F.row_number().over(order),
            "start": F.coalesce(F.sum(F.expr(f"{marks}L + length(own_role) + length(own_text)")).over(before), F.lit(0)),
            "safe_start": F.coalesce(F.sum(F.expr(f"{marks}L + length(safe_role) + length(safe_text)")).over(before), F.lit(0)),
        }
    )
    gathered = placed.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct("at", "role", "text", "fits", "own_role", "own_text", "start", "safe_role", "safe_text", "safe_start")
            )
        ).alias("t")
    )

    def joined(role: str, text: str) -> str:
        return f"array_join(transform(t, x -> {rendered('x.' + role, 'x.' + text)}), '')"

    def spans(start: str, role: str, text: str) -> str:
        span = f"struct(x.{start} + {len(OPEN) + len(CLOSE)} + length(x.{role}) AS start, length(x.{text}) AS length)"
        return f"transform(filter(t, x -> x.role = '{LEARNED}'), x -> {span})"

    first = gathered.selectExpr(
        "conv_id", "t", "transform(t, x -> struct(x.role AS role, x.text AS text)) AS turns", f"{joined('own_role', 'own_text')} AS own"
    ).withColumn("own_fits", F.expr(f"{parsed('own')} <=> turns"))
    return first.selectExpr(
        "conv_id", "turns",
        f"IF(own_fits, own, {joined('safe_role', 'safe_text')}) AS formatted",
        f"IF(own_fits, {spans('start', 'own_role', 'own_text')}, {spans('safe_start', 'safe_role', 'safe_text')}) AS loss_spans",
        "CASE WHEN NOT own_fits THEN 2 WHEN exists(t, x -> NOT x.fits) THEN 1 ELSE 0 END AS level",
    ).withColumn("identical", F.expr(f"{parsed('formatted')} <=> turns"))


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of what the formatted text and the loss mask say, from (conv_id, formatted, loss_spans)."""
    learned = unescaped("substring(formatted, CAST(s.start + 1 AS int), s.length)")
    return chats.selectExpr(
        "conv_id", "formatted", f"{parsed('formatted')} AS found",
        f"array_join(transform(loss_spans, s -> {learned}), '') AS loss",
    ).selectExpr(
        "conv_id", "CAST(size(found) AS bigint) AS n_turns",
        "sha2(array_join(transform(found, x -> concat(x.role, '\\n', x.text, '\\n')), ''), 256) AS turns_sha256",
        "CAST(length(loss) AS bigint) AS loss_chars", "sha2(loss, 256) AS loss_sha256",
        "CAST(length(formatted) AS bigint) AS formatted_chars",
    )
