"""Best-fit packing, its bounds, and the packed rows."""

import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cityflow.llm import bestfit, token_output
from cityflow.llm.queries import QUERIES, WORD_BPE
from helpers import CLASHING, DOCUMENTS, EDGES, clashing, stored


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


def plain_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting)[1]] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


def fewest(lengths, capacity):
    """By trying every assignment."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i]:
                place(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(3))
def test_both_searches_pack_as_plain_best_fit_does(seed):
    rng = random.Random(seed)
    for _ in range(60):
        capacity = rng.choice([7, 50, 64])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 90))]
        sequence, offset, fill = bestfit.best_fit_decreasing(np.array(lengths), capacity)
        rows = token_output.packed(lengths, capacity)
        assert len(fill) == len(rows) == plain_best_fit(lengths, capacity)
        assert sorted(itertools.chain(*rows)) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in row) <= capacity for row in rows)
        for k in range(len(fill)):
            at = 0
            for i in sorted(np.flatnonzero(sequence == k), key=lambda i: offset[i]):
                assert offset[i] == at
                at += lengths[i]
            assert at == fill[k] <= capacity


def test_bounds_hold_and_are_often_met():
    rng = random.Random(4)
    met = 0
    for _ in range(120):
        capacity = rng.choice([10, 24])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 8))]
        counts = np.bincount(lengths, minlength=capacity + 1)
        bound, least = bestfit.least_sequences(bestfit.bound_sums(counts, capacity)), fewest(lengths, capacity)
        assert bound <= least
        met += bound == least
    assert met > 90
    # more than half each: one per sequence, though they fill little over half
    assert bestfit.least_sequences(bestfit.bound_sums(np.bincount([1100] * 9, minlength=2049), 2048)) == 9
    # more than a third each: two per sequence
    assert bestfit.least_sequences(bestfit.bound_sums(np.bincount([700] * 9, minlength=2049), 2048)) == 5


def pieces(library, rows, capacity):
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for number, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            yield doc_id, number, start, len(part), zlib.crc32(part.tobytes())


def check(found, wanted, capacity):
    rows = [tuple(r) for r in found.collect()]
    assert sorted((r[:5] for r in rows), key=str) == sorted(wanted, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r[5], []).append((r[6], r[3]))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [2048, 16, 1])
def test_packing_of_edges(spark, tmp_path, library, capacity):
    wanted = list(pieces(library, [r[:2] for r in EDGES], capacity))
    for rows, schema in ((EDGES, DOCUMENTS), (clashing(EDGES), CLASHING)):
        found = bestfit.pack(stored(spark, tmp_path, rows, schema), WORD_BPE, capacity).cache()
        used = check(found, wanted, capacity)
        assert bestfit.certificate(found, capacity) == (used, used)


def test_partitions_exchange_what_they_leave_over(spark, tmp_path, library, monkeypatch):
    monkeypatch.setattr(bestfit, "PIECES_PER_TASK", 40)
    rng = random.Random(0)
    rows = [(i, " ".join(["to"] * rng.randint(1, 40)), "en", "s", 0) for i in range(600)]
    docs = stored(spark, tmp_path, rows, parts=12)
    found = bestfit.pack(docs, WORD_BPE, 64).cache()
    used = check(found, list(pieces(library, [r[:2] for r in rows], 64)), 64)
    least = bestfit.certificate(found, 64)[1]
    alone = sum(
        plain_best_fit([min(64, len(t.split()) + 1) for t in part], 64)
        for part in docs.select("text").rdd.map(lambda r: r[0]).glom().collect()
    )
    assert least <= used < alone
    assert used <= least + 2


def test_no_rows(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert bestfit.pack(empty, WORD_BPE).count() == 0
    assert token_output.write_rows(empty, WORD_BPE).count() == 0


def test_registered_packing_is_whole_and_near_the_bound(spark, sf_dir, library):
    found = QUERIES["op8_best_fit_packing"](spark, sf_dir).cache()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    used = check(found, list(pieces(library, docs, 2048)), 2048)
    assert used <= bestfit.certificate(found)[1] + 1


@pytest.mark.parametrize("window", [1 << 22, 50])
def test_rows_restore_every_text(spark, tmp_path, library, window):
    for rows, schema in ((EDGES, DOCUMENTS), (clashing(EDGES), CLASHING)):
        found = token_output.write_rows(stored(spark, tmp_path, rows, schema), WORD_BPE, 128, window=window).cache()
        for r in found.collect():
            assert len(r["ids"]) == 256
            assert r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] <= 128
            assert r["position_resets"] == r["cu_seqlens"][:-1]
            assert not any(r["ids"][2 * r["n_tokens"] :])
        assert found.select("row_id").distinct().count() == found.count()
        parts = sorted(map(tuple, token_output.restored(found).collect()), key=str)
        wanted = []
        for doc_id, text in (r[:2] for r in rows):
            ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, token_output.END_ID], "<u2")
            wanted += [(doc_id, n, s, bytes(ids[s : s + 128].tobytes())) for n, s in enumerate(range(0, len(ids), 128))]
        assert sorted(((a, b, c, bytes(d)) for a, b, c, d in parts), key=str) == sorted(wanted, key=str)


def test_registered_rows_restore_every_text(spark, sf_dir, library):
    rows = token_output.restored(QUERIES["op7_token_rows"](spark, sf_dir)).orderBy("doc_id", "piece").collect()
    found = {}
    for r in rows:
        found[r["doc_id"]] = found.get(r["doc_id"], b"") + bytes(r["ids"])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert found == {
        d: np.array([*library.encode(t, add_special_tokens=False).ids, token_output.END_ID], "<u2").tobytes() for d, t in docs
    }
