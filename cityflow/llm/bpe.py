"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding.

The encoder reads symbols and holds back as many of them as the merge list can need. ``lookahead``
computes that number: what comes later can change a token boundary only through a chain of rules
that reaches back to it. Each link of the chain is a rule of higher rank whose right part is the
left part or the product of the link before, so the longest such chain, measured in symbols, bounds
the influence. A boundary further back than that is final, everything before it is emitted, and the
buffer starts anew there. Texts are taken in blocks cut at white space, so beside the text and its tokens
memory grows with the longest stretch without white space alone. Most words are shorter than
the lookahead and end, as the word's end is a boundary in any case; their tokens are remembered.

The decoder is a state machine over token bytes: it keeps an unfinished UTF-8 character (and whether
a joining blank is due) between calls, so ids may arrive in any portions.

Tokenizer files are those of the ``tokenizers`` library (BPE with byte-level symbols); their path is
a parameter. Normalisation and word boundaries of characters outside the plain range are the
library's own; merging is done here.

Defined cases: a null or empty text has no tokens and decodes to the empty text; strings of special
tokens become their ids; further columns are ignored; repeated rows give repeated results.
"""

import codecs
import functools
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from cityflow.llm.common import columns_of, per_batch

BLOCK_CHARS = 1 << 16
CACHED_WORDS = 500_000
ID = np.dtype("<u4")
_NO_RULE = 1 << 60
_SHIFT = 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where Latin-1 prints it, else the
    next free one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


def lookahead(rules: list[tuple[int, int, int]], length: dict[int, int]) -> int:
    """Symbols that must be known behind a boundary before it is final.

    ``rules`` are (left, right, product) in order of rank. ``crossed[t]``: how far back, in symbols,
    the fate of a token ``t`` can reach across its left edge by rules of higher rank; ``held[t]``:
    the same where a rule extends ``t`` to the right, which leaves its left edge in place.
    """
    crossed: dict[int, int] = {}
    held: dict[int, int] = {}
    for left, right, product in reversed(rules):
        reach = max(crossed.get(left, 0), crossed.get(product, 0), held.get(left, 0), held.get(product, 0))
        held[left] = max(held.get(left, 0), reach)
        crossed[right] = max(crossed.get(right, 0), length[left] + reach)
    return max(crossed.values(), default=0)


class Merges:
    """Merge rules over ids, and the transducer that applies them."""

    def __init__(self, rules: list[tuple[int, int, int]], length: dict[int, int]):
        made = set()
        for left, right, product in rules:
            if product in made or not all(length[part] == 1 or part in made for part in (left, right)):
                raise ValueError("the merge list makes a token twice, or uses one before it is made")
            made.add(product)
        self.rank = {left << _SHIFT | right: rank for rank, (left, right, _) in enumerate(rules)}
        self.product = [product for _, _, product in rules]
        self.length = length
        self.lookahead = lookahead(rules, length)

    def merged(self, symbols: list[int]) -> list[int]:
        """All tokens of a complete sequence; lowest rank first, leftmost first among equals."""
        if len(symbols) > 48:
            return self._merged_by_heap(symbols)
        get, out = self.rank.get, list(symbols)
        ranks = [get(a << _SHIFT | b, _NO_RULE) for a, b in zip(out, out[1:])]
        while ranks:
            best = min(ranks)
            if best == _NO_RULE:
                break
            i = ranks.index(best)
            out[i] = made = self.product[best]
            del out[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(out[i - 1] << _SHIFT | made, _NO_RULE)
            if i < len(ranks):
                ranks[i] = get(made << _SHIFT | out[i + 1], _NO_RULE)
        return out

    def _merged_by_heap(self, symbols: list[int]) -> list[int]:
        get, out, n = self.rank.get, list(symbols), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(out[i] << _SHIFT | out[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if out[i] >= 0 else n
            if j >= n or get(out[i] << _SHIFT | out[j]) != rank:
                continue
            out[i], out[j] = self.product[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get(out[i] << _SHIFT | out[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (p := before[i]) >= 0 and (r := get(out[p] << _SHIFT | out[i])) is not None:
                heapq.heappush(heap, (r, p))
        return [token for token in out if token >= 0]

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """The tokens of one word, emitted once they are stable; the buffer stays bounded."""
        pending: list[int] = []
        full = 2 * self.lookahead + 64
        for symbol in symbols:
            pending.append(symbol)
            if len(pending) == full:
                tokens, at = self.merged(pending), 0
                for token in tokens:
                    if at + self.length[token] > full - self.lookahead:
                        break
                    at += self.length[token]
                    yield token
                # a token can be longer than the part that is final: then the buffer grows by it
                pending = pending[at:]
                full = max(2 * self.lookahead + 64, len(pending) + self.lookahead + 64)
        yield from self.merged(pending)


class _Remembered(dict):
    """Results by key, forgotten all at once when there are too many."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.compute(key)
        return value


# The characters whose classes and lower case are the same in Python and in the library.
_PLAIN = re.compile("[\x00-\x1b\x20-ԯ‐-‧€]*")
# White space of the library: without U+001C to U+001F, which Python counts as such.
_BLANKS = re.compile("[\t-\r \x85\xa0  -     　]+")


def _plain_words(ending: bool) -> re.Pattern:
    """Words of a text of plain characters that holds no white space."""
    if not ending:
        raise ValueError("only tokenizers that drop white space are supported")
    digits = "0-9²³¹¼-¾"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[^\W_{digits}]+|[{digits}]|(?:[^\w\s]|_)+")


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        rules = []
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            rules.append((vocabulary[left], vocabulary[right], vocabulary[left + right]))
        symbols = byte_symbols()
        length = {i: len(t.removesuffix(suffix) if suffix and t != suffix else t) for t, i in vocabulary.items()}
        self.inner = [vocabulary[s] for s in symbols]
        self.last = [vocabulary[s + suffix] for s in symbols]
        self.of_symbol = {s: b for b, s in enumerate(symbols)}
        self.merges = Merges(rules, length)
        self.library = Tokenizer.from_file(path)
        self.plain_words = _plain_words(bool(suffix))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.byte_level = spec.get("decoder") is not None
        names = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.special.items()}
        self.token_bytes = {i: self._bytes_of(t, i) for i, t in names.items()}
        self.words = _Remembered(self._word, CACHED_WORDS)
        self.chunks = _Remembered(self._chunk, CACHED_WORDS)

    def _bytes_of(self, token: str, token_id: int) -> bytes:
        if not self.byte_level or token_id in self.special.values():
            return token.encode()
        return bytes(self.of_symbol[s] for s in token)

    # encoding

    def _ids_of_bytes(self, word: bytes) -> bytes:
        symbols = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        tokens = self.merges.merged(symbols) if len(symbols) <= self.merges.lookahead else self.merges.stream(symbols)
        ids = array("I", tokens)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _word(self, word: str) -> bytes:
        return self._ids_of_bytes(word.encode())

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a text without white space and special tokens."""
        if chunk.isascii() and chunk.isprintable():
            return b"".join([self.words[w] for w in self.plain_words.findall(chunk.lower())])
        if _PLAIN.fullmatch(chunk) and unicodedata.is_normalized("NFC", chunk):
            lowered = chunk.replace("Σ", "σ").lower()  # one letter at a time: no final sigma
            return b"".join([self.words[w] for w in self.plain_words.findall(lowered)])
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return b"".join(self._ids_of_bytes(bytes(self.of_symbol[s] for s in word)) for word, _ in words)

    def _segment(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        split = text.split()
        # str.split also cuts at U+001C to U+001F, which are ordinary characters here
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            split = _BLANKS.split(text)
        chunks = self.chunks
        return b"".join([chunks[c] for c in split if c])

    def blocks(self, text: str) -> Iterator[bytes]:
        """Ids of ``text`` as little-endian unsigned 32-bit integers, block by block."""
        start = 0
        while start < len(text):
            gap = _BLANKS.search(text, start + BLOCK_CHARS)
            end = gap.start() if gap else len(text)
            block = text if start == 0 and end == len(text) else text[start:end]
            if any(s in block for s in self.special):
                at = 0
                for found in self.special_pattern.finditer(block):
                    yield self._segment(block[at : found.start()])
                    yield np.array([self.special[found[0]]], ID).tobytes()
                    at = found.end()
                yield self._segment(block[at:])
            else:
                yield self._segment(block)
            start = end

    def encode(self, text: str | None) -> bytes:
        return b"".join(self.blocks(text or ""))

    # decoding

    def decoder(self) -> "Decoder":
        return Decoder(self)

    def decode(self, ids: Iterable[int]) -> str:
        decoder = self.decoder()
        return decoder.feed(ids) + decoder.finish()


class Decoder:
    """Ids to text, in any portions. Without a byte-level decoder tokens are joined by blanks."""

    def __init__(self, codec: Codec):
        self.table, self.joiner = codec.token_bytes, b"" if codec.byte_level else b" "
        self.begun = False
        self.characters = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        pieces = [self.table[i] for i in ids if i in self.table]
        if not pieces:
            return ""
        joined = (self.joiner if self.begun else b"") + self.joiner.join(pieces)
        self.begun = True
        return self.characters.decode(joined)

    def finish(self) -> str:
        return self.characters.decode(b"", True)


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a file; one per Python worker."""
    return Codec(path)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the text decoded from them, per row."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def digests(text: str | None, tokenizer: Codec) -> tuple[int, str, str]:
        n, ids, decoded, decoder = 0, hashlib.sha256(), hashlib.sha256(), tokenizer.decoder()
        for block in tokenizer.blocks(text or ""):
            ids.update(block)
            n += len(block) // ID.itemsize
            decoded.update(decoder.feed(np.frombuffer(block, ID).tolist()).encode())
        decoded.update(decoder.finish().encode())
        return n, ids.hexdigest(), decoded.hexdigest()

    def columns(batch: pa.RecordBatch) -> dict:
        tokenizer = codec(path)
        found = [digests(text, tokenizer) for text in columns_of(batch, "text")[0]]
        n, ids, decoded = zip(*found) if found else ((), (), ())
        return {"doc_id": batch.column("doc_id"), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

    return docs.selectExpr("CAST(doc_id AS bigint) doc_id", "text").mapInArrow(
        per_batch(columns, schema), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of every row's whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def columns(batch: pa.RecordBatch) -> dict:
        tokenizer = codec(path)
        return {"doc_id": batch.column("doc_id"), "ids": [tokenizer.encode(t) for t in columns_of(batch, "text")[0]]}

    return docs.selectExpr("CAST(doc_id AS bigint) doc_id", "text").mapInArrow(
        per_batch(columns, schema), "doc_id bigint, ids binary"
    )
