"""Exact deduplication against a dictionary."""

import hashlib

import pytest

from cityflow.llm import exact_dedup
from helpers import CLASHING, DOCUMENTS, EDGES, LONG, clashing, stored


def lowered(text):
    return (text or "").encode().lower()


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(lowered(r[1]), []).append(r[0])
    result = []
    for r in rows:
        members = groups[lowered(r[1])]
        result.append((r[0], max((m for m in members if m is not None), default=None), len(members)))
    return sorted(result, key=str), len(groups)


ROWS = EDGES + [(30, LONG + "!", "en", "c", 1), (31, LONG.upper(), "en", "c", 1), (32, "É É", "en", "c", 1), (33, "é é", "en", "c", 1)]


# a lambda, so that it is sent to the workers by value
one_bit = lambda text: bytes([hashlib.sha256(text).digest()[0] & 1])


@pytest.mark.parametrize("digest", [exact_dedup.sha256, one_bit])
@pytest.mark.parametrize("files", [1000, 1])
def test_rows_of_edges(spark, tmp_path, digest, files):
    """Also with a digest of one bit, under which unlike texts meet, and with a file per batch."""
    docs = stored(spark, tmp_path, ROWS, parts=4)
    found = exact_dedup.deduplicate(docs, digest, files).collect()
    wanted, groups = expected(ROWS)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in found), key=str) == wanted
    assert sum(r["kept"] for r in found) == groups
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])
    assert len({r["at"] for r in found}) == len(ROWS)


def test_a_frame_that_is_not_of_files(spark):
    rows = clashing(ROWS)
    found = exact_dedup.keep_one(spark.createDataFrame(rows, CLASHING))
    assert found.columns == spark.createDataFrame([], CLASHING).columns
    wanted, groups = expected(ROWS)
    assert found.count() == groups
    assert sorted((r["doc_id"] for r in found.collect()), key=str) == sorted({k for _, k, _ in wanted} | {None}, key=str)


def test_further_documents_meet_the_state(spark, tmp_path):
    """A second call goes on from the first: files that arrived before are not taken again."""
    folder = str(tmp_path / "state")
    first, second = ROWS[::2], [*ROWS[1::2], (99, "one", "en", "z", 3)]
    one, two = stored(spark, tmp_path, first, parts=2), stored(spark, tmp_path, second, parts=2)
    assert exact_dedup.deduplicate(one, folder=folder).count() == len(first)
    assert exact_dedup.deduplicate(one, folder=folder).count() == len(first)
    found = exact_dedup.deduplicate(two, folder=folder).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in found), key=str) == expected([*first, *second])[0]
    assert exact_dedup.deduplicate(one.limit(0), folder=folder).count() == len(first) + len(second)


def test_unlike_texts_of_one_digest_meet_across_calls(spark, tmp_path):
    folder = str(tmp_path / "state")
    rows = [(1, "a", "en", "x", 1), (2, "A", "en", "x", 1)], [(3, "b", "en", "x", 1), (4, "a", "en", "x", 1)]
    same = lambda text: b"0"
    for part in rows:
        found = exact_dedup.deduplicate(stored(spark, tmp_path, part, parts=1), same, folder=folder).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in found) == [(1, 4, 3), (2, 4, 3), (3, 3, 1), (4, 4, 3)]


def test_no_rows(spark, tmp_path):
    empty = stored(spark, tmp_path, [])
    assert exact_dedup.deduplicate(empty).collect() == []
    assert exact_dedup.keep_one(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_settings_are_put_back(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    exact_dedup.deduplicate(stored(spark, tmp_path, ROWS[:2]))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_registered_query_equals_a_dictionary(spark, sf_dir):
    from cityflow.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op10_exact_dedup"](spark, sf_dir).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in found), key=str) == expected(docs)[0]
    texts = dict(docs)
    assert all(r["text_sha256"] == hashlib.sha256(lowered(texts[r["doc_id"]])).hexdigest() for r in found)
