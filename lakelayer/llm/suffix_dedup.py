"""Repeated passages by a logarithmic family of sampled suffix arrays.

A byte is removed if a string of ``length`` bytes that covers it starts anywhere else, in the same document or another.

* Sampling. Of the suffixes of a text only those are indexed that begin at a minimiser: the smallest fingerprint of
  ``gram`` bytes within a ``length``-byte window. Equal windows have equal minimisers, so no match of that length is lost.
* Suffix arrays. A batch's sampled suffixes are sorted by the fingerprint of their first ``gram`` bytes (equality is all
  the scan needs, so the order is that of fingerprints, not of bytes) and stored as a bucketed, sorted table.
* Index family. A new array is merge-joined with every existing level (same buckets, no shuffle), which yields the
  fingerprints with several places; then equal-sized levels merge, as in a binary counter, and the old ones are removed.
* Extension. Suffixes of such fingerprints are cut into runs of windows that share a minimiser. Runs that are equal as a
  whole are settled by count. The others, one per distinct run, are compared window by window within their fingerprint;
  a fingerprint with more than ``big_group`` distinct runs is compared by a distributed count over its windows instead.

Texts are reduced to their distinct contents first (per task, then per content), so a group of copies costs one index
entry per task; contents travel compressed, in a table bucketed by content key that later joins reuse without a shuffle.
Strings are compared by 64-bit fingerprints within equal minimisers, contents by 128 bits.

Defined results: null text is the empty text; texts shorter than ``length`` bytes lose nothing; a text that occurs twice
loses everything if it is long enough; repeated rows and ids are rows of their own; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakelayer.llm.common import col, shuffle_partitions, small_batches, stored, text_or_empty
from lakelayer.session import scratch_dir

_BASE = np.uint64(0x9E3779B97F4A7C15)        # odd, so it has an inverse modulo 2 ** 64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


class Windows:
    """Fingerprints of the windows of some texts laid end to end, and their runs by minimiser."""

    _up = np.ones(1, np.uint64)
    _down = np.ones(1, np.uint64)

    def __init__(self, texts: list[bytes], length: int, gram: int):
        self.length, self.texts = length, texts
        size = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
        n = len(flat)
        if len(Windows._up) <= n:
            one = np.ones(1, np.uint64)
            Windows._up = np.cumprod(np.concatenate([one, np.full(n + 1024, _BASE)]))
            Windows._down = np.cumprod(np.concatenate([one, np.full(n + 1024, _INVERSE)]))
        flat += np.uint64(1)
        flat *= Windows._up[:n]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat)])
        width = length - gram + 1
        own = np.maximum(size - length + 1, 0)                 # windows of each text
        self.doc = np.repeat(np.arange(len(texts)), own)
        if not len(self.doc):
            self.start = self.n = self.key = self.owner = np.empty(0, np.int64)
            self.again = np.empty(0, bool)
            return
        h = self.prints(np.arange(n - gram + 1), gram)
        low, span = h, 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
        place = np.arange(len(self.doc)) - np.repeat(np.cumsum(own) - own, own) + self.begin[self.doc]
        m = low[place]
        new = np.ones(len(place), bool)
        new[1:] = (m[1:] != m[:-1]) | (self.doc[1:] != self.doc[:-1])
        first = np.flatnonzero(new)
        self.n = np.diff(np.append(first, len(place)))         # windows of each run
        self.start, self.key, self.owner = place[first], m[first].view(np.int64), self.doc[first]
        # a minimiser that leaves the window while the minimum stays: the run holds its fingerprint twice
        twice = np.zeros(len(place), bool)
        twice[:-1] = (h[place[:-1]] == m[:-1]) & ~new[1:]
        self.again = np.logical_or.reduceat(twice, first)

    def prints(self, at: np.ndarray, n) -> np.ndarray:
        """Fingerprints of the strings of n bytes at these places."""
        return _mix((self.sums[at + n] - self.sums[at]) * Windows._down[at])

    def run_prints(self, runs: np.ndarray) -> np.ndarray:
        n = self.n[runs] + self.length - 1
        return _mix(self.prints(self.start[runs], n) + n.astype(np.uint64)).view(np.int64)


def _unpack(blob: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(blob)


def _chunks(blobs: list, limit: int = 2_000_000):
    """(start, stop, texts) of about ``limit`` bytes; a longer text is alone."""
    start, size, texts = 0, 0, []
    for i, b in enumerate(blobs):
        t = _unpack(b)
        if texts and size + len(t) > limit:
            yield start, i, texts
            start, size, texts = i, 0, []
        texts.append(t)
        size += len(t)
    if texts:
        yield start, len(blobs), texts


def _contents(keyed: DataFrame, batches: int, n: int) -> DataFrame:
    """Distinct contents (c1, c2, blob) with a batch number, bucketed by c1."""
    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        z, seen = zstandard.ZstdCompressor(3), set()
        for b in rows:
            keep, blobs = [], []
            for i, key in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if key not in seen:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(key)
                    keep.append(i)
                    blobs.append(z.compress(b.column(2)[i].as_py().encode("utf-8", "surrogatepass")))
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(blobs, pa.binary())],
                                             ["c1", "c2", "blob"])

    once = (keyed.select("c1", "c2", "text").mapInArrow(pack, "c1 long, c2 long, blob binary")
            .repartition(n, "c1").dropDuplicates(["c1", "c2"])
            .withColumn("batch", F.pmod(F.shiftright("c2", 7), F.lit(batches)).cast("int")))
    return _bucketed(once, "c1", n, "contents", partition="batch", compression="none")


def _bucketed(df: DataFrame, key: str, n: int, label: str, partition: str | None = None,
              compression: str = "zstd") -> DataFrame:
    """Store as a table bucketed (and sorted) by ``key`` under the shared scratch folder."""
    return _Stored(df, key, n, label, partition, compression).rows


class _Stored:
    """A bucketed table and the folder that holds it."""

    def __init__(self, df: DataFrame, key: str, n: int, label: str, partition: str | None = None,
                 compression: str = "zstd"):
        self.spark, self.path = df.sparkSession, scratch_dir(df.sparkSession, label)
        self.name = "llm_" + self.path.rsplit("-", 1)[1]
        w = df.write.bucketBy(n, key).sortBy(key).options(path=self.path, compression=compression)
        (w.partitionBy(partition) if partition else w).saveAsTable(self.name)
        self.rows = self.spark.table(self.name)

    def remove(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def _suffixes(contents: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, c1) of every sampled suffix; twice where a run holds its minimiser again."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for i, j, texts in _chunks(b.column(1).to_pylist()):
                w = Windows(texts, length, gram)
                c1 = b.column(0).slice(i, j - i).to_numpy()[w.owner] if len(w.owner) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([w.key, w.key[w.again]])),
                                                  pa.array(np.concatenate([c1, c1[w.again]]))], ["key", "c1"])

    return contents.select("c1", "blob").mapInArrow(run, "key long, c1 long")


def _index(contents: DataFrame, batches: int, n: int, length: int, gram: int) -> tuple[list[DataFrame], DataFrame]:
    """Feed the batches to the index family: the final levels, and the fingerprints with several places."""
    levels: dict[int, _Stored] = {}
    found = []
    for b in range(batches):
        array = _suffixes(contents.where(F.col("batch") == b), length, gram)
        new = _Stored(array.repartition(n, "key"), "key", n, "suffixes")
        hits = new.rows.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key")
        for old in levels.values():
            hits = hits.union(new.rows.select("key").join(old.rows.select("key"), "key", "left_semi").distinct())
        found.append(stored(hits.distinct(), "repeated"))
        size = 0
        while size in levels:
            old = levels.pop(size)
            both = _Stored(new.rows.unionByName(old.rows).repartition(n, "key"), "key", n, "suffixes")
            old.remove()
            new.remove()
            new, size = both, size + 1
        levels[size] = new
    keys = found[0]
    for f in found[1:]:
        keys = keys.union(f)
    return [level.rows for level in levels.values()], keys.distinct()


def _runs_of(contents: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs (key, whole, c1, c2, start, n, again) of contents whose fingerprint is in ``wanted`` (c1, keys)."""
    salt = np.uint64(0x9E3779B97F4A7C15)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            keys = b.column(3).to_pylist()
            for i, j, texts in _chunks(b.column(2).to_pylist()):
                w = Windows(texts, length, gram)
                mark = np.arange(j - i, dtype=np.uint64) * salt
                want = np.concatenate([np.array(k, np.int64).view(np.uint64) ^ mark[d]
                                       for d, k in enumerate(keys[i:j])])
                pick = np.flatnonzero(np.isin(w.key.view(np.uint64) ^ (mark[w.owner]), want))
                doc = w.owner[pick]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.key[pick]), pa.array(w.run_prints(pick)),
                     pa.array(b.column(0).to_numpy()[i:j][doc]), pa.array(b.column(1).to_numpy()[i:j][doc]),
                     pa.array(w.start[pick] - w.begin[doc]), pa.array(w.n[pick]), pa.array(w.again[pick])],
                    ["key", "whole", "c1", "c2", "start", "n", "again"])

    return (contents.join(wanted, "c1").select("c1", "c2", "blob", "keys")
            .mapInArrow(run, "key long, whole long, c1 long, c2 long, start long, n long, again boolean"))


def _window_prints(contents: DataFrame, asked: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, whole, big, times, prints) of the runs in ``asked`` (c1, c2, runs: key, whole, start, n, big, times)."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            lists = b.column(1).to_pylist()
            for i, j, texts in _chunks(b.column(0).to_pylist()):
                w = Windows(texts, length, gram)
                out = []
                for d, runs in enumerate(lists[i:j]):
                    for r in runs:
                        at = w.begin[d] + r["start"] + np.arange(r["n"])
                        out.append((r["key"], r["whole"], r["big"], r["times"], w.prints(at, length).view(np.int64)))
                cols = list(zip(*out)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.bool_()),
                     pa.array(cols[3], pa.int64()), pa.array(list(cols[4]), pa.list_(pa.int64()))],
                    ["key", "whole", "big", "times", "prints"])

    per = asked.groupBy("c1", "c2").agg(F.collect_list(F.struct("key", "whole", "start", "n", "big", "times")).alias("runs"))
    return (contents.join(per, ["c1", "c2"]).select("blob", "runs")
            .mapInArrow(run, "key long, whole long, big boolean, times long, prints array<long>"))


def _ranges(hit: np.ndarray, length: int) -> list[dict]:
    """Byte ranges, relative to a run's start, covered by its repeated windows."""
    at = np.flatnonzero(hit)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    return [{"s": int(s), "e": int(e) + length} for s, e in zip(at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]])]


def _compare(length: int):
    """Runs of whole fingerprints, sorted by key: windows that occur twice within their fingerprint."""
    def settle(keys, wholes, prints):
        group = np.cumsum(np.r_[0, keys[1:] != keys[:-1]]).astype(np.uint64)
        n = np.array([len(p) for p in prints])
        flat = np.concatenate(prints).view(np.uint64)
        mixed = flat + np.repeat(group, n) * np.uint64(0xD6E8FEB86659FD93)
        _, inverse, count = np.unique(mixed, return_inverse=True, return_counts=True)
        hit = count[inverse] > 1
        ends = np.cumsum(n)
        out = [_ranges(hit[e - m:e], length) for e, m in zip(ends, n)]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(wholes),
             pa.array(out, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))], ["key", "whole", "ranges"])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, wholes, prints, size = [], [], [], 0
        for b in rows:
            values, at = b.column(2).values.to_numpy(), b.column(2).offsets.to_numpy()
            for k, w, s, e in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), at[:-1], at[1:]):
                if size > 500_000 and k != keys[-1]:
                    yield settle(np.array(keys), np.array(wholes), prints)
                    keys, wholes, prints, size = [], [], [], 0
                keys.append(k)
                wholes.append(w)
                prints.append(values[s:e])
                size += int(e - s)
        if keys:
            yield settle(np.array(keys), np.array(wholes), prints)

    return run


def _by_window(big: DataFrame, length: int) -> DataFrame:
    """The same for frequent fingerprints, as a distributed count over their windows."""
    rows = big.select("key", "whole", F.posexplode("prints").alias("at", "print"))
    many = rows.groupBy("key", "print").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key", "print")
    hit = rows.join(many, ["key", "print"], "left_semi").groupBy("key", "whole").agg(F.collect_list("at").alias("at"))
    return hit.select("key", "whole", F.transform("at", lambda x: F.struct(
        x.cast("long").alias("s"), (x + length).cast("long").alias("e"))).alias("ranges"))


def repeated_spans(contents: DataFrame, batches: int, n: int, length: int, gram: int,
                   big_group: int = 20_000) -> DataFrame:
    """(c1, c2, spans): byte ranges of each content to remove, not merged."""
    levels, keys = _index(contents, batches, n, length, gram)
    places = levels[0]
    for level in levels[1:]:
        places = places.unionByName(level)
    wanted = (places.join(keys, "key", "left_semi").groupBy("c1").agg(F.collect_set("key").alias("keys")))
    runs = stored(_runs_of(contents, wanted, length, gram), "runs")
    kinds = runs.groupBy("key", "whole").agg(F.count(F.lit(1)).alias("times"), F.max("again").alias("again"),
                                             F.min(F.struct("c1", "c2", "start", "n")).alias("r"))
    per_key = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    kinds = stored(kinds.join(per_key, "key").select("key", "whole", "times", "again", "kinds", "r.*"), "run-kinds")
    whole = kinds.where("times > 1").select("key", "whole", F.array(F.struct(
        F.lit(0).cast("long").alias("s"), (F.col("n") + length - 1).alias("e"))).alias("ranges"))
    asked = kinds.where("kinds > 1 or (times = 1 and again)").withColumn("big", F.col("kinds") > big_group)
    prints = stored(_window_prints(contents, asked, length, gram), "window-prints")
    near = (prints.where(~F.col("big")).select("key", "whole", "prints").repartition(n, "key")
            .sortWithinPartitions("key")
            .mapInArrow(_compare(length), "key long, whole long, ranges array<struct<s:long,e:long>>"))
    far = _by_window(prints.where("big"), length)
    parts = near.unionByName(far).join(kinds.where("times = 1").select("key", "whole"), ["key", "whole"], "left_semi")
    verdict = whole.unionByName(parts.where(F.size("ranges") > 0))
    return (runs.join(verdict, ["key", "whole"]).select("c1", "c2", "start", F.explode("ranges").alias("x"))
            .groupBy("c1", "c2").agg(F.collect_list(F.struct((F.col("start") + F.col("x.s")).alias("s"),
                                                             (F.col("start") + F.col("x.e")).alias("e"))).alias("spans")))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in rows:
        out = []
        for blob, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            text = _unpack(blob)
            gone = merged([(x["s"], x["e"]) for x in spans])
            kept, at = [], 0
            for s, e in gone:
                kept.append(text[at:s])
                at = e
            kept.append(text[at:])
            out.append((sum(e - s for s, e in gone), len(gone), hashlib.sha256(b"".join(kept)).hexdigest(),
                        [{"s": s, "e": e} for s, e in gone]))
        cols = list(zip(*out)) if out else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.string()),
             pa.array(list(cols[3]), pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))],
            ["c1", "c2", "n_removed", "n_spans", "kept_sha256", "spans"])


def repeated_passages(df: DataFrame, length: int = 200, gram: int = 48, batches: int = 4, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte spans."""
    small_batches(df.sparkSession)
    n = shuffle_partitions(df.sparkSession)
    keyed = df.select(col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    keyed = keyed.withColumns({"c1": F.xxhash64("text"), "c2": F.xxhash64(F.lit(1), "text")})
    long_enough = F.octet_length("text") >= length
    contents = _contents(keyed.where(long_enough), batches, n)
    spans = repeated_spans(contents, batches, n, length, gram)
    cut = stored(contents.select("c1", "c2", "blob").join(spans, ["c1", "c2"]).select("c1", "c2", "blob", "spans")
                 .mapInArrow(_cut, "c1 long, c2 long, n_removed long, n_spans long, kept_sha256 string, "
                                   "spans array<struct<s:long,e:long>>"), "cut")
    copies = keyed.where(long_enough).groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    fate = cut.join(copies, ["c1", "c2"], "full_outer")
    rows = keyed.select("doc_id", "c1", "c2", F.octet_length("text").cast("long").alias("n_bytes"),
                        F.sha2("text", 256).alias("sha"))
    twice = F.col("copies").isNotNull() & (F.col("n_bytes") >= length)
    return rows.join(fate, ["c1", "c2"], "left").select(
        "doc_id", "n_bytes",
        F.when(twice, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(twice, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(twice, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(twice, F.array(F.struct(F.lit(0).cast("long").alias("s"), F.col("n_bytes").alias("e"))))
        .otherwise(F.coalesce("spans", F.array().cast("array<struct<s:long,e:long>>"))).alias("spans"))
