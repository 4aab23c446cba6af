"""SQL text helpers."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(value) -> str:
    """A Python value as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_of(x: str, values: Sequence) -> str:
    return f"({x}) IN ({', '.join(literal(v) for v in values)})"


def case(x: str, mapping: dict, default) -> str:
    arms = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in mapping.items())
    return f"CASE {x} {arms} ELSE {literal(default)} END"


def columns(texts: Iterable[str]) -> list[Column]:
    return [F.expr(text) for text in texts]
