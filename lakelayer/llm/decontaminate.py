"""Benchmark passages in documents by a prefix-filtered join.

An item contributes every run of ``window`` consecutive words (a shorter item its whole text). A window lies in a document
only if all its word shingles do, so with shingles ordered by rarity (their count over all documents) one shingle is the
necessary prefix: the rarest. The steps are Spark jobs; no benchmark text passes through the driver:

1. the distinct windows, one row per shingle of each, stored;
2. a count over all documents of the shingles that the windows hold; the rarest of each window becomes its prefix, and a
   window with a shingle that no document holds is out;
3. every place of a prefix shingle in a document, with the words around it, joined to the windows of that prefix. The
   place fixes where a window would start; the length and position bounds drop windows that would stick out of the
   document, and the words of the rest are compared as text;
4. the hits of a text, merged into spans, and the ids of the items behind them, joined back to the documents by the
   SHA-256 of their texts, so copies of a text are searched once after the scan.

Shingles are compared as 64-bit hashes up to step 3, which only costs work where two collide. Both document scans pass over
shingles that a bitmap of the wanted hashes excludes. The bitmap has at most ``filter_bits`` bits whatever the benchmark's
size; with more windows than it can tell apart, more shingles pass on to the exact steps. Rows of one prefix or window are
dealt out over ``SALTS`` groups.

Defined results: null or wordless texts have no words and are clean; items without words are ignored; a null item id
counts as the empty string; items that repeat an id count once; repeated document rows are judged alike; with an empty
benchmark nothing is contaminated. Other columns pass through ``find_windows`` untouched, but for columns named as its
results, which it replaces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from lakelayer.llm.common import col, small_batches, stored, text_or_empty
from lakelayer.llm.tokens import chunks

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))
_SHINGLE = 3
SALTS = 8

_PIECE = 1 << 17                                          # bytes hashed at once
_GROUP = 1 << 20                                          # bytes of texts looked at together
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(_PIECE, base, np.uint64))])


_POWER, _INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts, one after another: where they start and stop in ``low`` (the lower-cased texts, a space
    between them), which text they belong to, and a hash of each."""

    def __init__(self, texts: list[bytes]):
        self.low = b" ".join(texts).translate(_TABLE)
        chars = np.frombuffer(self.low, np.uint8)
        edge = np.flatnonzero(np.diff((chars != 32).astype(np.int8), prepend=np.int8(0), append=np.int8(0)))
        self.start, self.stop = edge[::2], edge[1::2]
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.text = np.searchsorted(ends, self.start, "right")
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))      # first word of each text
        self.hash = self._hashes(chars)

    def _hashes(self, chars: np.ndarray) -> np.ndarray:
        """A polynomial of the bytes of each word, from running sums over pieces of whole words."""
        out = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(out):
            lo = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.stop, lo + _PIECE, "right")))
            part = chars[lo:self.stop[j - 1]]
            if len(part) > _PIECE:
                out[i] = xxhash.xxh64_intdigest(part.tobytes())
            else:
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * _POWER[:len(part)])])
                a = self.start[i:j] - lo
                out[i:j] = (sums[self.stop[i:j] - lo] - sums[a]) * _INVERSE[a]
            i = j
        return _mix(out)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``size`` words inside one text."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        key = np.full(n, size, np.uint64)
        for k in range(size):
            key = _mix(key * np.uint64(_BASE) ^ self.hash[k:k + n])
        at = np.flatnonzero(self.text[:n] == self.text[size - 1:])
        return at, key[at]


def _groups(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= _GROUP or len(held) >= 10_000:
            yield held
            held, size = [], 0
    if held:
        yield held


# ---- benchmark ----

def windows_of(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(item, win, len): the windows of every item, once each; ``win`` is the lower-cased words with one space between."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = text.translate(_TABLE).split()
                n = min(len(words), window)
                last = len(words) - n + 1 if words else 0
                for s in range(0, last, 10_000):
                    wins = [b" ".join(words[k:k + n]) for k in range(s, min(last, s + 10_000))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(wins), pa.string()), pa.array(wins, pa.binary()),
                         pa.array([n] * len(wins), pa.int32())], ["item", "win", "len"])

    rows = items.select(F.coalesce(col(id_col).cast("string"), F.lit("")), text_or_empty(text_col).cast("binary"))
    return rows.mapInArrow(cut, "item string, win binary, len int").distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """(win, len, at, size, hash): every shingle of the distinct windows."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for wins in _groups(b.column(0).to_pylist()):
                w = Words(wins)
                long = np.diff(w.first)
                for size in range(1, _SHINGLE + 1):
                    at, key = w.shingles(size)
                    owner = w.text[at]
                    use = np.minimum(long[owner], _SHINGLE) == size
                    at, key, owner = at[use], key[use], owner[use]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([wins[k] for k in owner.tolist()], pa.binary()), pa.array(long[owner], pa.int32()),
                         pa.array(at - w.first[owner], pa.int32()), pa.array(np.full(len(at), size), pa.int32()),
                         pa.array(key.view(np.int64))], ["win", "len", "at", "size", "hash"])

    return windows.select("win").distinct().mapInArrow(split, "win binary, len int, at int, size int, hash long")


class Filter:
    """A bitmap that holds two bits of every wanted shingle hash, and the sizes of those shingles."""

    def __init__(self, cells: np.ndarray, sizes: list[int]):
        self.cells, self.sizes = cells, sizes
        self.mask = np.uint64(len(cells) * 64 - 1)

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return (self.cells[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)

    def may_hold(self, key: np.ndarray) -> np.ndarray:
        return (self._bit(key & self.mask) & self._bit((key >> np.uint64(32)) & self.mask)).astype(bool)


def filter_of(wanted: DataFrame, filter_bits: int) -> Filter:
    """The bitmap of the ``hash`` column: bits are set by an aggregate, so the driver gets at most ``filter_bits`` / 64
    cells of it. It has about 32 bits a hash, a power of two, up to ``filter_bits``."""
    shape = wanted.agg(F.count("*").alias("n"), F.collect_set("size").alias("sizes")).first()
    bits = min(max(1 << 12, 1 << (32 * shape["n"]).bit_length()), filter_bits)
    bit = F.explode(F.array(*[h.bitwiseAND(F.lit(bits - 1)) for h in (col("hash"), F.shiftrightunsigned("hash", 32))]))
    cells = wanted.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS INT))")).alias("set"))
    got = cells.toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[got.column("cell").to_numpy()] = got.column("set").to_numpy().view(np.uint64)
    return Filter(out, sorted(shape["sizes"]))


# ---- documents ----

@F.arrow_udf(LongType())
def word_count(texts: pa.Array) -> pa.Array:
    """The number of words of every text (bytes, no nulls): the places where a word starts."""
    counts = [np.zeros(0, np.int64)]
    for _, _, some in chunks(texts):
        held = some.to_pylist()
        low = np.frombuffer(b"".join(t + b" " for t in held).translate(_TABLE), np.uint8)
        starts = np.flatnonzero(np.diff(low != 32, prepend=False) & (low != 32))
        ends = np.cumsum([len(t) + 1 for t in held])
        counts.append(np.diff(np.searchsorted(starts, ends), prepend=0))
    return pa.array(np.concatenate(counts).astype(np.int64))


def count_shingles(texts: DataFrame, wanted: Filter) -> DataFrame:
    """(hash, n): how often the shingles that pass the filter occur in all texts."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for b in batches:
            for group in _groups(v.as_py() for v in b.column(0)):
                w = Words(group)
                keys = [k[f.may_hold(k)] for k in (w.shingles(s)[1] for s in f.sizes)]
                if keys:
                    key, n = np.unique(np.concatenate(keys), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n, pa.int64())], ["hash", "n"])

    return texts.mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def places(texts: DataFrame, wanted: Filter, window: int) -> DataFrame:
    """(key, pos, hash, lead, around): every place of a shingle that passes the filter, once per distinct text: its first
    word, and the words that a window over it can hold, ``lead`` of them before it. ``key`` is the text's SHA-256."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for b in batches:
            for group in _groups(v.as_py() for v in b.column(0)):
                w, names = Words(group), {}
                for size in f.sizes:
                    at, key = w.shingles(size)
                    hit = f.may_hold(key)
                    at, key = at[hit], key[hit]
                    for s in range(0, len(at), 10_000):
                        part = at[s:s + 10_000]
                        owner = w.text[part]
                        begin, end = w.first[owner], w.first[owner + 1]
                        lo, hi = np.maximum(begin, part - (window - size)), np.minimum(end, part + window)
                        for k in owner.tolist():
                            if k not in names:
                                names[k] = hashlib.sha256(group[k]).hexdigest()
                        around = [b" ".join(w.low[x:y].split()) for x, y in zip(w.start[lo].tolist(), w.stop[hi - 1].tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([names[k] for k in owner.tolist()], pa.string()), pa.array(part - begin, pa.int64()),
                             pa.array(key[s:s + 10_000].view(np.int64)), pa.array(part - lo, pa.int32()),
                             pa.array(around, pa.binary())], ["key", "pos", "hash", "lead", "around"])

    return texts.mapInArrow(look, "key string, pos long, hash long, lead int, around binary").distinct()


def salted_join(many: DataFrame, few: DataFrame, on: str, by: Column) -> DataFrame:
    """An equality join whose left rows of one key are dealt out over ``SALTS`` groups by ``by``."""
    left = many.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    right = few.withColumn("salt", F.explode(F.array(*[F.lit(s) for s in range(SALTS)])))
    return left.join(right, [on, "salt"]).drop("salt")


def prefixes(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """(win, len, hash, at): each window's rarest shingle, ties to the smaller hash, then the earlier place. Windows with a
    shingle that no document holds are left out."""
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "at")
    least = shingles.join(counts, "hash", "left").groupBy("win", "len", "size").agg(F.min(rarity).alias("p"))
    return least.where("p.n > 0").select("win", "len", "size", "p.hash", "p.at")


def occurrences(texts: DataFrame, windows: DataFrame, window: int, filter_bits: int) -> DataFrame:
    """(key, start, stop, win): every occurrence of a window in a distinct text, in words."""
    shingles = stored(window_shingles(windows), "shingles")
    counts = count_shingles(texts, filter_of(shingles, filter_bits))
    chosen = stored(prefixes(shingles, counts), "prefixes")
    found = places(texts, filter_of(chosen, filter_bits), window)
    pairs = salted_join(found, chosen.drop("size"), "hash", F.struct("key", "pos"))
    words = F.split(F.col("around").cast("string"), " ", -1)
    begin = F.col("lead") - F.col("at")
    fits = (begin >= 0) & (begin + F.col("len") <= F.size(words))               # position and length bounds
    same = F.array_join(F.slice(words, F.greatest(begin, F.lit(0)) + 1, F.col("len")), " ") == F.col("win").cast("string")
    start = F.col("pos") - F.col("at")
    return pairs.where(fits & same).select("key", start.alias("start"), (start + F.col("len")).alias("stop"), "win")


def merged_spans(hits: DataFrame) -> DataFrame:
    """(key, hit_spans): overlapping and touching ranges of a text as one."""
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    longest = hits.groupBy("key", "start").agg(F.max("stop").alias("stop"))
    new = F.coalesce((F.col("start") > F.max("stop").over(before)).cast("int"), F.lit(1))
    run = longest.withColumn("new", new).withColumn("run", F.sum("new").over(upto))
    spans = run.groupBy("key", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("hit_spans"))


def find_windows(df: DataFrame, items: DataFrame, window: int = 10, filter_bits: int = 1 << 26,
                 text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``hit_spans`` (word ranges inside occurring windows, merged) and ``items`` (sorted ids
    as strings) appended. ``filter_bits`` is a power of two of at least 64. The rows come in no particular order."""
    small_batches(df.sparkSession)
    text = text_or_empty(text_col)
    texts = df.select(text.cast("binary").alias("text")).where("length(text) > 0")
    windows = stored(windows_of(items, window, item_id, item_text), "windows")
    hits = stored(occurrences(texts, windows, window, filter_bits), "hits")
    held = salted_join(hits.select("key", "win").distinct(), windows.select("item", "win"), "win", F.col("key"))
    names = held.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    key = "key"
    while key in df.columns:
        key += "_"
    found = merged_spans(hits).join(names, "key").withColumnRenamed("key", key)
    docs = df.drop("hit_spans", "items").withColumns({"n_words": word_count(text.cast("binary")),
                                                      key: F.sha2(text.cast("binary"), 256)})
    spans, ids = "array<struct<start:long,stop:long>>", "array<string>"
    return docs.join(found, key, "left").withColumns({
        "hit_spans": F.coalesce("hit_spans", F.array().cast(spans)), "items": F.coalesce("items", F.array().cast(ids))}).drop(key)


def contamination(df: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  **kw) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    slim = df.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    found = find_windows(slim, items, window, **kw)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
