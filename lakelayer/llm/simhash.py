"""SimHash near-duplicates with pigeonring candidates.

The 64 bits are eight segments of eight on a ring. If two fingerprints differ in at most three bits, some start has all
its chains in budget: the first l segments from there differ in at most floor(3 l / 8) bits, that is 0, 0, 1, 1, 1, 2, 2,
3. So from that start two segments are equal, and of the three behind them at least two are: 3 keys of 32 exact bits for
each of 8 starts. Fingerprints that share a key meet in one task, are pruned by the chain budgets and checked in full.
Distinct fingerprints only take part, each task emits a spanning forest of the links it finds rather than all pairs, and
keys with more than ``block`` fingerprints are dealt out as pairs of blocks, so no group is unbounded in a task and no
link is lost. Components come from alternating large-star and small-star steps on stored edge tables.

Defined results: null or wordless texts have fingerprint zero and link like any other; a component's id is its smallest
non-null id (null if there is none); repeated rows and ids are separate rows of the result; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakelayer.llm.common import col, shuffle_partitions, small_batches, stored, text_or_empty

SEGMENTS, WIDTH = 8, 8


def fingerprint(text: str, words: int = 3) -> int:
    import xxhash
    w = text.encode("utf-8", "surrogatepass").lower().split()       # A-Z only; splits at 0x20 and 0x09-0x0D
    if not w:
        return 0
    if len(w) < words:
        grams = [b" ".join(w)]
    else:
        grams = map(b" ".join, zip(*(w[k:] for k in range(words))))
    one = xxhash.xxh64_intdigest
    h = np.fromiter((one(g, 42) for g in grams), "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):               # a long text's bits are counted in parts
        part = h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed 64-bit) and text_hash of every row."""
    small_batches(df.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), b.column(2)], ["doc_id", "fp", "text_hash"])

    text = text_or_empty(text_col)
    return (df.select(col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
            .mapInArrow(run, "doc_id long, fp long, text_hash long"))


def budgets(bits: int) -> list[int]:
    return [bits * (k + 1) // SEGMENTS for k in range(SEGMENTS)]


def _keys(bits: int):
    """Array column of 64-bit keys: 40 bits from each start without one of segments 3 to 5, and a tag in the low byte."""
    if bits != 3:
        raise ValueError("the key layout is made for 3 differing bits")
    out = []
    for i in range(SEGMENTS):
        r = F.col("fp") if not i else F.shiftleft("fp", WIDTH * i).bitwiseOR(F.shiftrightunsigned("fp", 64 - WIDTH * i))
        for c in range(3):
            mask = 0xFFFFFFFFFF000000 & ~(0xFF << (64 - WIDTH * (3 + c)))
            mask = mask - (1 << 64) if mask >> 63 else mask
            out.append(r.bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(3 * i + c).cast("long")))
    return F.array(*out)


def _linked(x: np.ndarray, y: np.ndarray, start: np.ndarray | int, bits: int) -> np.ndarray:
    """Chain budgets from ``start``, then the full count."""
    d = x ^ y
    s = np.asarray(start, np.uint64) * np.uint64(WIDTH)
    d = np.where(s == 0, d, (d << s) | (d >> ((np.uint64(64) - s) & np.uint64(63))))
    ok = np.ones(np.broadcast(d).shape, bool)
    for k, most in enumerate(budgets(bits)):
        part = d >> np.uint64(64 - WIDTH * (k + 1))
        ok &= np.bitwise_count(part) <= most
    return ok


def _forest(fps: np.ndarray, start: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of one key's links, by breadth-first passes over what is not reached yet."""
    left = fps
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            q = front.pop()
            hit = _linked(left, q, start, bits)
            if hit.any():
                found = left[hit]
                yield np.full(len(found), q, np.uint64), found
                front.extend(found)
                left = left[~hit]


def _links(bits: int, small: int = 32):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(a, b):
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        def group(key, u, v, fp):
            """Whole groups only."""
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])])
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(key)))
            start = (key & np.int64(0xFF)) // 3
            of = np.repeat(size, size)
            run_id = np.cumsum(new)
            for d in range(1, small):
                i = np.flatnonzero((run_id[d:] == run_id[:-d]) & (of[d:] <= small))
                if not len(i):
                    break
                ok = _linked(fp[i], fp[i + d], start[i], bits)
                yield from rows(fp[i][ok], fp[i + d][ok])
            for s, n in zip(first[size > small], size[size > small]):
                for a, b in _forest(fp[s:s + n], int(start[s]), bits):
                    yield from rows(a, b)

        held = None
        for b in batches:
            cur = [b.column(i).to_numpy() for i in range(3)] + [b.column(3).to_numpy().view(np.uint64)]
            if held is not None:
                cur = [np.concatenate(x) for x in zip(held, cur)]
            if not len(cur[0]):
                continue
            last = (cur[0] == cur[0][-1]) & (cur[1] == cur[1][-1]) & (cur[2] == cur[2][-1])
            cut = len(last) - int(last.sum())
            held = [x[cut:] for x in cur]
            if cut:
                yield from group(*(x[:cut] for x in cur))
        if held is not None:
            yield from group(*held)

    return run


def links(fps: DataFrame, bits: int = 3, block: int = 8192) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose components are those of all pairs within ``bits``."""
    keys = fps.select("fp", F.explode(_keys(bits)).alias("key"))
    many = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    dealt = (keys.join(many, "key").withColumn("k", parts).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
             .select("key", F.least("own", "other").alias("u"), F.greatest("own", "other").alias("v"), "fp"))
    n = shuffle_partitions(fps.sparkSession)
    return (dealt.repartition(n, "key", "u", "v").sortWithinPartitions("key", "u", "v", "fp")
            .mapInArrow(_links(bits), "a long, b long"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge. Alternating star steps on stored tables."""
    cur = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(),
                 "edges")
    before = None
    for _ in range(most_rounds):
        both = cur.select("u", "v").union(cur.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        cur = stored(small, "edges")
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == now:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def near_duplicates(df: DataFrame, words: int = 3, bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, fp, text_hash, component (a fingerprint) and component_id (smallest id) of every row."""
    rows = stored(fingerprints(df, words, id_col, text_col), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    root = components(links(fps.select("fp"), bits))
    named = (fps.join(root, fps.fp == root.node, "left")
             .select("fp", "first_id", F.coalesce("root", "fp").alias("component")))
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return rows.join(named.drop("first_id").join(ids, "component"), "fp")


def near_duplicate_query(df: DataFrame, words: int = 3, bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(df, words, bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(df: DataFrame, words: int = 3, bits: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose id is the smallest of their component (null ids last, ties by the text's hash)."""
    near = near_duplicates(df, words, bits, id_col, text_col)
    first = (near.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id",
                                                          "text_hash")).alias("w"))
             .select(F.col("w.doc_id").alias("_wid"), F.col("w.text_hash").alias("_wth")))
    th = F.xxhash64(text_or_empty(text_col))
    return df.join(first, (th == F.col("_wth")) & col(id_col).cast("long").eqNullSafe(F.col("_wid")), "left_semi")
