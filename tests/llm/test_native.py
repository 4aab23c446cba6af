"""Chat formatting and line deduplication: SQL functions against Python, and plans without Python."""

import hashlib
import random

import pytest

from cityflow.llm import chat, line_dedup
from cityflow.llm.queries import QUERIES
from helpers import CLASHING, DOCUMENTS, EDGES, clashing, stored

CHATS = "conv_id bigint, turn bigint, role string, text string"
MARKS = ["</s>", "<s>", "[INST]", "[/INST]", " [/INST]", "[INST] ", "&", "&a;", "&e;", "&amp;", "<", "/s>", "</s", "\n", "é", "👍", "\\", "$1", ""]


def digests(rows):
    """conv_id: the contract's columns but for the formatted length."""
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv, turns in talks.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        found[conv] = (
            len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
        )
    return found


def read(frame):
    return {r[0]: tuple(r[1:5]) for r in chat.read_back(frame).collect()}


def test_any_content_is_read_back(spark):
    rng = random.Random(0)

    def content():
        return "".join(rng.choice(MARKS) for _ in range(rng.randint(0, 8)))

    rows = [
        (conv, turn, rng.choice(["user", "assistant", "assistant", "system", content()]), content())
        for conv in range(150) for turn in range(rng.randint(1, 6))
    ]
    found = chat.format_chats(spark.createDataFrame(rows, CHATS)).cache()
    assert found.filter("NOT identical").count() == 0
    assert read(found) == digests(rows)
    assert {r["level"] for r in found.select("level").collect()} <= {0, 1}
    for r in found.collect():
        spans = "".join(r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss_spans"])
        for plain, code in reversed(chat.CODES.items()):
            spans = spans.replace(code, plain)
        assert spans == "".join(t["text"] for t in r["turns"] if t["role"] == "assistant")


def test_only_conflicting_turns_are_escaped(spark):
    rows = [(1, 0, "user", "R&D <b> [x]"), (1, 1, "assistant", "ends </s> here & there"), (2, 0, "user", "plain & simple")]
    found = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, CHATS)).collect()}
    assert found[1]["formatted"] == "[INST] user [/INST]R&D <b> [x]</s>[INST] assistant [/INST]ends &e; here &a; there</s>"
    assert (found[1]["level"], found[2]["level"]) == (1, 0)
    assert found[2]["formatted"] == "[INST] user [/INST]plain & simple</s>"


def test_edges_of_chats(spark):
    rows = [
        (1, 0, None, None), (1, None, "assistant", "first"), (2, 3, "assistant", None), (2, 3, "assistant", None),
        (3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "assistant", "c"), (None, 0, "user", "x"), (None, 1, "assistant", "y"),
        (4, 0, "assistant", "long " * 200_000), *((5, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(700)),
    ]
    found = chat.format_chats(spark.createDataFrame(rows, CHATS))
    assert read(found) == digests(rows)
    assert found.filter("NOT identical").count() == 0
    more = spark.createDataFrame([(*r, "x", 1, True) for r in rows], CHATS + ", formatted string, at bigint, identical boolean")
    assert read(chat.format_chats(more)) == digests(rows)
    assert chat.format_chats(spark.createDataFrame([], CHATS)).count() == 0


def test_the_parser_refuses_what_does_not_follow_the_grammar(spark):
    for text, turns in (
        ("", []), ("[INST] user [/INST]a</s>", [("user", "a")]), ("user: a</s>", [None]), ("[INST] user a</s>", [None]),
    ):
        found = spark.range(1).selectExpr(f"{chat.parsed(repr(text))} AS t").first()["t"]
        assert [t and tuple(t) for t in found] == turns


def cleaned(rows, sites):
    spread = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if line.strip(" ") and r[3] is not None:
                spread.setdefault(line.strip(" "), set()).add(r[3])
    gone = {line for line, found in spread.items() if len(found) >= sites}
    result = []
    for r in rows:
        lines = [] if r[1] is None else r[1].split("\n")
        left = [x for x in lines if x.strip(" ") not in gone]
        result.append((r[0], None if r[1] is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(result, key=str)


@pytest.mark.parametrize("schema", [DOCUMENTS, CLASHING])
def test_lines_of_edges(spark, tmp_path, schema):
    rng = random.Random(1)
    rows = list(EDGES)
    for i in range(300):
        lines = [f"own {i}", "", f"spread {rng.randint(0, 9)}", "  spread 0 ", f"own {i}"]
        rows.append((100 + i, "\n".join(lines[: rng.randint(1, 5)]), "en", rng.choice([None, *"abcdefgh"]), 0))
    rows += [(500 + k, f"at the edge {n}", "en", f"s{k}", 0) for n in (9, 10, 11) for k in range(n)]
    rows += [(600, "alone\nspread 0", "en", "a", 0), (601, "spread 0\nspread 0", "en", "a", 0)]
    for sites in (3, 10):
        docs = stored(spark, tmp_path, clashing(rows) if schema == CLASHING else rows, schema)
        found = line_dedup.clean(docs, sites=sites)
        assert sorted(map(tuple, found.collect()), key=str) == cleaned(rows, sites)
    assert line_dedup.clean(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_a_line_on_most_rows(spark, tmp_path):
    rows = [(i, f"everywhere\nrow {i}", "en", f"s{i % 12}", 0) for i in range(2000)]
    found = line_dedup.clean(stored(spark, tmp_path, rows))
    assert found.filter("n_removed = 1").count() == 2000


@pytest.mark.parametrize("name", ["op4_chat_formatting", "op9_line_dedup"])
def test_native_plans_hold_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
