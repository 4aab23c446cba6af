"""Encoding and decoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from cityflow.llm import bpe
from cityflow.llm.queries import WORD_BPE
from helpers import DOCUMENTS, EDGES, clashing, stored, CLASHING


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(WORD_BPE)


def ids(codec, text):
    return np.frombuffer(codec.encode(text), bpe.ID).tolist()


ALPHABETS = [
    "aeinrst", "ab", "the of", "éèêÀ", "abcdefghijklmnopqrstuvwxyz'0123 \n.,!<|>", "Σσςİß\x1c\x85\xa0᠎​Ω", "日本語ひらカナ", "👍🏽a",
    "́e̊", "²½٣೬", "ԯ֊ݸ",
]


@pytest.mark.parametrize("seed", range(4))
def test_encoding_equals_the_library(codec, library, seed):
    rng = random.Random(seed)
    for _ in range(400):
        letters = rng.choice(ALPHABETS) + rng.choice(ALPHABETS)
        text = "".join(rng.choice(letters) for _ in range(rng.choice([1, 5, 40, 600])))
        if rng.random() < 0.2:
            text = text[:3] + "<|endoftext|>" + text[3:]
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids(codec, text) == wanted
        assert codec.decode(wanted) == library.decode(wanted, skip_special_tokens=False)


def test_blocks_are_cut_where_the_library_sees_white_space(codec, library):
    filler = ("plain words " * 6000)[: bpe.BLOCK_CHARS - 6]
    for c in "\x1c\x1d\x1e\x1f":
        text = f"{filler}!!!!!!!!{c}!!!! and on"
        assert ids(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_stream_holds_a_bounded_buffer_and_equals_the_library(codec, library):
    rng = random.Random(7)
    longest = 0
    merged = codec.merges.merged

    def watched(symbols):
        nonlocal longest
        longest = max(longest, len(symbols))
        return merged(symbols)

    codec.merges.merged = watched
    try:
        for letters in ("aeinrst", "ab", "abcdefghijklmnopqrstuvwxyz", "a"):
            word = "".join(rng.choice(letters) for _ in range(20_000))
            symbols = [codec.inner[b] for b in word.encode()[:-1]] + [codec.last[ord(word[-1])]]
            assert list(codec.merges.stream(symbols)) == library.encode(word, add_special_tokens=False).ids
    finally:
        del codec.merges.merged
    assert longest <= 3 * codec.merges.lookahead + 128


def test_lookahead_follows_a_chain():
    # a+b waits for nothing; c+a (later) waits for it; d+c waits for that
    length = {0: 1, 1: 1, 2: 1, 3: 1, 10: 2, 11: 2, 12: 2}
    assert bpe.lookahead([(0, 1, 10)], length) == 1
    assert bpe.lookahead([(0, 1, 10), (2, 0, 11)], length) == 2
    assert bpe.lookahead([(0, 1, 10), (2, 0, 11), (3, 2, 12)], length) == 3
    assert bpe.lookahead([(3, 2, 12), (2, 0, 11), (0, 1, 10)], length) == 1


def test_improper_merge_lists_are_refused():
    with pytest.raises(ValueError):
        bpe.Merges([(10, 1, 11), (0, 1, 10)], {0: 1, 1: 1, 10: 2, 11: 3})


def test_heap_and_list_merging_agree(codec):
    rng = random.Random(3)
    for _ in range(200):
        symbols = [codec.inner[ord(rng.choice("aeinrsthlo"))] for _ in range(rng.randint(1, 48))]
        assert codec.merges.merged(symbols) == codec.merges._merged_by_heap(symbols)


def test_decoder_takes_any_portions(codec):
    text = "hello world's 12 éè 👍"
    found = ids(codec, text)
    for step in (1, 2, 5):
        decoder = codec.decoder()
        parts = [decoder.feed(found[i : i + step]) for i in range(0, len(found), step)]
        assert "".join(parts) + decoder.finish() == codec.decode(found)


def test_byte_level_decoding_waits_for_whole_characters(codec):
    plain = bpe.Codec(WORD_BPE)
    plain.byte_level = True
    plain.token_bytes = {i: bytes([b]) for b, i in enumerate(plain.inner)}
    data = "aé日👍".encode()
    decoder = plain.decoder()
    assert "".join(decoder.feed([plain.inner[b]]) for b in data) + decoder.finish() == "aé日👍"
    decoder = plain.decoder()
    assert decoder.feed([plain.inner[0xE6]]) + decoder.finish() == "�"


def expected(library, text):
    found = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(found, skip_special_tokens=False)
    return len(found), hashlib.sha256(np.array(found, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_round_trip_of_edges(spark, tmp_path, library):
    for rows, schema in ((EDGES, DOCUMENTS), (clashing(EDGES), CLASHING)):
        found = bpe.round_trip(stored(spark, tmp_path, rows, schema), WORD_BPE).collect()
        assert sorted(map(tuple, found), key=str) == sorted(((r[0], *expected(library, r[1])) for r in rows), key=str)
    assert bpe.round_trip(spark.createDataFrame([], DOCUMENTS), WORD_BPE).collect() == []


def test_registered_query_equals_the_library(spark, sf_dir, library):
    from cityflow.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r[0]: tuple(r[1:]) for r in QUERIES["op5_bpe_round_trip"](spark, sf_dir).collect()}
    assert found == {d: expected(library, t) for d, t in docs}
