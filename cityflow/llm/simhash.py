"""SimHash near-duplicates through deletion variants.

A fingerprint of 64 bits is cut into two segments of 32. Of two fingerprints that differ in at most
two bits, one segment differs in at most one bit, so the two agree in one of that segment's 32
variants with one bit left out. Every distinct fingerprint is indexed under its 64 variants and dealt
by variant; equal variants are verified by counting the bits that differ. A pair that agrees in
several variants is taken at the first only.

Variants shared by few fingerprints compare them pairwise; those shared by up to ``RUN`` do so in
blocks and tie each member to the first one of its component instead of giving the pairs. Variants shared by more stream past
without being held: their fingerprints go on to finer variants, with one bit left out of either
segment or two out of the other one, which at most four fingerprints share and which need no
verification. So no group is gathered and no pair lost at any size.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; rows with
equal text share the fingerprint; repeated rows are returned each; a null ``doc_id`` never names a
component unless there is no other; no rows give no rows; further columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import columns_of, located, per_batch, saved
from cityflow.llm.components import components

WORDS = 3
MAX_BITS = 2
SEED = 42
DIRECT, RUN = 16, 4096
_HALF = np.uint64(0xFFFFFFFF)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The SimHash of the shingles of a text: a bit is set if over half of their hashes set it."""
    found = text.lower().split()  # bytes: A-Z only, cut at ASCII white space
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(found) > words:
        starts, ends = starts[: 1 - words or None], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of ``keep`` (strings or bigints) and fp, the fingerprint's bits as a bigint."""
    frame = docs.selectExpr("CAST(doc_id AS bigint) doc_id", *keep, "CAST(text AS binary) text")
    out = frame.withColumn("fp", F.lit(0).cast("bigint")).drop("text").schema
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    arrow = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in out])

    def columns(batch: pa.RecordBatch) -> dict:
        (texts,) = columns_of(batch, "text")
        found = np.array([fingerprint(t or b"", words) for t in texts], "<u8").view("<i8")
        return {name: batch.column(name) for name in ("doc_id", *keep)} | {"fp": pa.array(found)}

    return frame.mapInArrow(per_batch(columns, arrow), out)


# --- links between distinct fingerprints


def first_variant(differing: np.ndarray) -> np.ndarray:
    """The first of the 64 variants in which two fingerprints with these differing bits agree, 64 if none."""
    low, high = differing & _HALF, differing >> np.uint64(32)

    def place(segment: np.ndarray) -> np.ndarray:
        # 0 for equal segments, the bit's number for one differing bit
        return np.where(segment == 0, 0, np.bitwise_count(segment - np.uint64(1)).astype(np.int64))

    few_low, few_high = np.bitwise_count(low) <= 1, np.bitwise_count(high) <= 1
    return np.where(few_low, place(low), np.where(few_high, 32 + place(high), 64))


def linked(a: np.ndarray, b: np.ndarray, variant: np.ndarray) -> np.ndarray:
    differing = a ^ b
    return (np.bitwise_count(differing) <= MAX_BITS) & (first_variant(differing) == variant)


def forest(prints: np.ndarray, variant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint of a variant with the first one it is connected with, itself excepted."""
    root = np.arange(len(prints))
    for i in range(1, len(prints)):
        near = root[:i][linked(prints[:i], prints[i], variant)]
        if len(near):
            roots = np.unique(near)
            root[i] = roots[0]
            if len(roots) > 1:
                root[:i][np.isin(root[:i], roots)] = roots[0]
    child = np.flatnonzero(root != np.arange(len(prints)))
    return prints[child], prints[root[child]]


def links_of_runs(keys: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal keys."""
    edge = np.flatnonzero(np.diff(keys)) + 1
    starts, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(keys)]))
    size = ends - starts
    small = np.repeat((size > 1) & (size <= DIRECT), size)
    k, p = keys[small], prints[small]
    for step in range(1, DIRECT):
        same = np.flatnonzero(k[:-step] == k[step:])
        if not len(same):
            break
        a, b = p[same], p[same + step]
        near = linked(a, b, k[same] >> 32)
        yield a[near], b[near]
    for start, end in zip(starts[size > DIRECT].tolist(), ends[size > DIRECT].tolist()):
        yield forest(prints[start:end], keys[start] >> 32)


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])


def links_by_variant(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) from rows (key, fp) sorted by both; rows of runs longer than ``run`` pass on as
    (a, null, key), without being held."""

    def rows(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        a, b = pa.array(a.view("<i8")), pa.array(b.view("<i8"))
        return pa.RecordBatch.from_arrays([a, b, pa.nulls(len(a), pa.int64())], schema=_FOUND)

    def passed_on(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        fp = pa.array(prints.view("<i8"))
        return pa.RecordBatch.from_arrays([fp, pa.nulls(len(fp), pa.int64()), pa.array(keys)], schema=_FOUND)

    def results(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        edge = np.flatnonzero(np.diff(keys)) + 1
        size = np.diff(np.concatenate(([0], edge, [len(keys)])))
        long = np.repeat(size > run, size)
        if long.any():
            yield passed_on(keys[long], prints[long])
        if not long.all():
            for a, b in links_of_runs(keys[~long], prints[~long]):
                if len(a):
                    yield rows(a, b)

    keys, prints, streaming = np.empty(0, np.int64), np.empty(0, "<u8"), None
    for batch in batches:
        k = batch.column("key").to_numpy(zero_copy_only=False)
        p = batch.column("fp").to_numpy(zero_copy_only=False).view("<u8")
        if not len(k):
            continue
        if streaming is not None:
            more = int(np.searchsorted(k, streaming, "right"))
            if more:
                yield passed_on(k[:more], p[:more])
            if more == len(k):
                continue
            k, p, streaming = k[more:], p[more:], None
        keys, prints = np.concatenate((keys, k)), np.concatenate((prints, p))
        last = int(np.searchsorted(keys, keys[-1], "left"))
        yield from results(keys[:last], prints[:last])
        keys, prints = keys[last:], prints[last:]
        if len(keys) > run:
            streaming = int(keys[-1])
            yield passed_on(keys, prints)
            keys, prints = keys[:0], prints[:0]
    yield from results(keys, prints)


def finer(overlong: DataFrame) -> DataFrame:
    """Links among fingerprints (key, fp) whose variant too many share.

    The variant leaves one bit out of a segment. Either one more bit is left out of the other
    segment, or, where the segment agrees in full, two are; whoever then agrees is within two bits.
    """
    bits = overlong.selectExpr(
        "fp", "key", "key >> 32 AS v", "IF(key >> 32 < 32, shiftrightunsigned(fp, 32), fp) & 4294967295 AS other",
        "IF(key >> 32 < 32, fp, shiftrightunsigned(fp, 32)) & 1 AS own",
    )
    out = "explode(sequence(0, 31)) AS j"
    one = bits.selectExpr("*", out).selectExpr("fp", "key", "j", "-1 AS k", "other & ~(1L << j) AS rest")
    two = (
        bits.filter("v % 32 = 0")
        .selectExpr("*", out)
        .filter("j < 31")
        .selectExpr("*", "explode(sequence(j + 1, 31)) AS k")
        .selectExpr("fp", "key", "j", "k", "(other & ~(1L << j) & ~(1L << k)) | (own << 32) AS rest")
    )
    return (
        one.unionByName(two)
        .groupBy("key", "j", "k", "rest")
        .agg(F.collect_set("fp").alias("fps"))  # four at most
        .filter("size(fps) > 1")
        .selectExpr("explode(fps) AS a", "array_min(fps) AS b")
        .filter("a <> b")
    )


def links(prints: DataFrame, run: int = RUN) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``prints`` (fp) that keep every component together."""
    variants = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v")).selectExpr(
        "(CAST(v AS bigint) << 32) | (shiftrightunsigned(fp, IF(v < 32, 0, 32)) & 4294967295 & ~(1L << (v % 32))) AS key", "fp"
    )
    found = saved(
        variants.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(lambda batches: links_by_variant(batches, run), "a bigint, b bigint, key bigint"),
        "simhash-links",
    )
    return (
        found.filter("key IS NULL")
        .select("a", "b")
        .unionByName(finer(found.filter("key IS NOT NULL").selectExpr("key", "a AS fp")))
    )


def grouped(docs: DataFrame, words: int = WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp and component_id of every row: the smallest doc_id reachable through links."""
    prints = saved(fingerprints(docs, words, keep), "simhash-prints")
    own = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    member = saved(components(links(own.select("fp"))).withColumnRenamed("node", "fp"), "simhash-members")
    lowest = member.join(own, "fp").groupBy("root").agg(F.min("low").alias("component_low"))
    whole = saved(
        own.join(member.join(lowest, "root"), "fp", "left").selectExpr("fp", "coalesce(component_low, low) AS component_id"),
        "simhash-components",
    )
    return prints.join(whole, "fp").select("doc_id", "fp", "component_id", *keep)


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row of each component of ``docs``, with its columns: the smallest doc_id, its first row."""
    rows = located(docs)
    placed = grouped(rows.selectExpr("doc.doc_id", "doc.text", "at.file", "at.row"), words, ("file", "row"))
    kept = (
        placed.filter("doc_id <=> component_id")
        .groupBy("component_id")
        .agg(F.min(F.struct("file", "row")).alias("at"))
        .select("at")
    )
    return rows.join(kept, "at", "left_semi").select("doc.*")
