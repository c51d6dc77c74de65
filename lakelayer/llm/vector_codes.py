"""Product codes of vectors; the nearest codebook entry is found with a GNAT over the entries.

Vectors become integers floor(scale * x), are cut into equal parts, and each part is coded by the index of the nearest of
its position's entries. Codebooks start from the vectors of the smallest ids and are refined in a fixed number of rounds,
all in integers, so a result is the same on every cluster.

The search tree (``Gnat``) picks split points among the entries, gives every other entry to its nearest split point and
stores, for each split point and each child, the least and greatest distance between them. A query measures its distance
to the split points; a child is left out when, seen from any split point, all its entries are farther than the best one
found. The comparison is strict and the stored ranges are widened beyond rounding, so an entry at an equal distance is
always measured; distances are compared as integers and ties go to the lower index.

Spark's part: the quantised vectors are stored once in the shared scratch folder; each round is one scan of that table
whose tasks send partial sums per (part, entry, position), added up by an aggregate. Only codebooks travel to the driver
and back: parts x entries x positions numbers, whatever the number of rows.

Defined results: rows whose vector is null or holds a null or non-finite component are left out; a null label is a label of
its own; a null id sorts behind all others; rows that repeat an id are rows like any other (ties among the first entries go by
label, then vector). Vectors shorter than the longest one, and a length that the parts do not divide, are filled with
zeros. Fewer rows than entries give as many entries as rows; an empty table gives an empty result and empty codebooks.
Other columns are ignored, whatever their names. A vector whose integer norm reaches 2**30 raises an error, because its
squared distances would not fit into a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lakelayer.llm.common import col, small_batches, stored
from lakelayer.llm.vectors import as_doubles, quantised, smallest_ids, usable

WIDER = 1e-9          # relative widening of stored distance ranges; float64 square roots err by less than 1e-15


class Gnat:
    """Nearest entry, ties to the lower index, for many query rows at once. ``entries``: (m, d) integers, m >= 1."""

    def __init__(self, entries: np.ndarray, degree: int = 4, members: np.ndarray | None = None):
        self.entries = np.ascontiguousarray(entries, np.int64)
        self.members = np.arange(len(entries)) if members is None else members
        own = self.entries[self.members]
        self.splits = self._spread(own, min(degree, len(own)))
        rest = np.setdiff1d(np.arange(len(own)), self.splits)
        dist = np.stack([np.sqrt(_squared(own, own[s]).astype(np.float64)) for s in self.splits])   # split x member
        nearest = dist[:, rest].argmin(0) if len(rest) else np.zeros(0, int)
        self.children, lo, hi = [], [], []
        for j in range(len(self.splits)):
            mine = rest[nearest == j]
            if not len(mine):
                continue
            inner = self.members[mine]
            self.children.append(Gnat(self.entries, degree, inner) if len(inner) > degree else inner)
            lo.append(dist[:, mine].min(1) * (1 - WIDER) - WIDER)
            hi.append(dist[:, mine].max(1) * (1 + WIDER) + WIDER)
        self.lo, self.hi = lo, hi                       # per child: range of distances from every split point
        self.splits = self.members[self.splits]

    @staticmethod
    def _spread(points: np.ndarray, n: int) -> np.ndarray:
        """Farthest-first choice, starting from the first entry."""
        chosen, far = [0], _squared(points, points[0])
        while len(chosen) < n:
            far[chosen] = -1
            chosen.append(int(far.argmax()))
            far = np.minimum(far, _squared(points, points[chosen[-1]]))
        return np.array(chosen)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(index, squared distance) of each query row's nearest entry, and the number of distances measured."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.entries))
        measured = self._search(queries, np.arange(len(queries)), best, index)
        return index, best, measured

    def _try(self, queries, rows, entry, best, index) -> np.ndarray:
        d2 = _squared(queries[rows], self.entries[entry])
        better = (d2 < best[rows]) | ((d2 == best[rows]) & (entry < index[rows]))
        best[rows[better]], index[rows[better]] = d2[better], entry
        return d2

    def _search(self, queries, rows, best, index) -> int:
        seen = [np.sqrt(self._try(queries, rows, s, best, index).astype(np.float64)) for s in self.splits]
        measured = len(rows) * len(seen)
        for child, lo, hi in zip(self.children, self.lo, self.hi):
            radius = np.sqrt(best[rows].astype(np.float64)) * (1 + WIDER) + WIDER
            out = np.zeros(len(rows), bool)
            for d, a, b in zip(seen, lo, hi):
                out |= (d + radius < a) | (d - radius > b)
            left = rows[~out]
            if not len(left):
                continue
            if isinstance(child, Gnat):
                measured += child._search(queries, left, best, index)
            else:
                for entry in child:
                    self._try(queries, left, int(entry), best, index)
                measured += len(left) * len(child)
        return measured


def _squared(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    diff = rows - one
    return np.einsum("ij,ij->i", diff, diff)


@dataclass
class Codebooks:
    entries: np.ndarray            # part x entry x position, integers

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _integers(df: DataFrame, id_col: str, vec_col: str, label_col: str, parts: int, scale: int) -> tuple[DataFrame, int]:
    """(vec_id, label, q: little-endian int32 components) of the usable rows, stored; and the padded width."""
    rows = df.where(usable(vec_col)).select(col(id_col).alias("vec_id"), col(label_col).alias("label"),
                                            as_doubles(vec_col).alias("v"))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts) * parts

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = quantised(b.column("v"), scale, width)
            if len(q) and np.linalg.norm(q, axis=1).max() >= 2.0 ** 30:
                raise ValueError("a vector's integer norm reaches 2**30; use a smaller scale")
            packed = q.astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array([r.tobytes() for r in packed], pa.binary())],
                ["vec_id", "label", "q"])

    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("q", T.BinaryType())])
    return stored(rows.mapInArrow(pack, schema), "vector-integers"), width


def _queries(b: pa.RecordBatch, width: int, parts: int) -> np.ndarray:
    """(row, part, position) integers of a batch of the stored table."""
    flat = np.frombuffer(b"".join(b.column("q").to_pylist()), "<i4").astype(np.int64)
    return flat.reshape(b.num_rows, parts, width // parts)


def _round(rows: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """One refinement: entries become the floored means of the parts assigned to them; unused entries stay."""
    parts, entries, size = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(x) for x in books if len(x)]
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            q = _queries(b, width, parts)
            for p, tree in enumerate(trees):
                index = tree.nearest(q[:, p])[0]
                for e in np.unique(index):
                    mine = q[index == e, p]
                    total[p, e] += mine.sum(0)
                    count[p, e] += len(mine)
        p, e = np.nonzero(count)
        both = np.concatenate([count[p, e][:, None], total[p, e]], axis=1)      # position 0: the count
        n = size + 1
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(p, n), pa.int32()), pa.array(np.repeat(e, n), pa.int32()),
                                          pa.array(np.tile(np.arange(n), len(p)), pa.int32()), pa.array(both.ravel())],
                                         ["part", "entry", "pos", "total"])

    found = (rows.select("q").mapInArrow(sums, "part int, entry int, pos int, total long")
             .groupBy("part", "entry", "pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    got = {(r["part"], r["entry"], r["pos"]): int(r["total"]) for r in found}
    out = books.copy()
    for p, e, pos in got:
        if pos:
            out[p, e, pos - 1] = got[p, e, pos] // got[p, e, 0]
    return out


def encode(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", *, parts: int = 8,
           entries: int = 16, scale: int = 4096, rounds: int = 6) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error) of every usable row, stored, and the codebooks. ``code`` has two hex digits a part;
    ``error`` is the squared distance between vector and code; ``entries`` is at most 256, ``scale`` a power of two."""
    if not 1 <= entries <= 256 or scale < 1 or scale & (scale - 1):
        raise ValueError("entries must be 1 to 256, scale a power of two")
    spark = df.sparkSession
    small_batches(spark, rows=20_000)
    rows, width = _integers(df, id_col, vec_col, label_col, parts, scale)
    first = smallest_ids(rows, "vec_id", entries, "label", "q")
    books = np.array([np.frombuffer(r["q"], "<i4") for r in first], np.int64).reshape(len(first), parts, width // parts)
    books = books.transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) and width else 0):
        books = _round(rows, books, width)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(x) for x in books if len(x)]
        for b in batches:
            q = _queries(b, width, parts)
            error, digits = np.zeros(b.num_rows, np.int64), np.zeros((b.num_rows, parts), np.uint8)
            for p, tree in enumerate(trees):
                index, d2, _ = tree.nearest(q[:, p])
                digits[:, p] = index
                error += d2
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array([r.tobytes().hex() for r in digits], pa.string()),
                 pa.array(error)], ["vec_id", "label", "code", "error"])

    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    return stored(rows.mapInArrow(code, schema), "vector-codes"), Codebooks(books)


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over rows of an equal label (nulls together). The sums are stored first, so
    the join knows their size: few labels are broadcast, many are joined by sorting."""
    sums = stored(codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return codes.join(sums, codes["label"].eqNullSafe(sums["_label"])).drop("_label")


def vector_codes_query(df: DataFrame) -> DataFrame:
    codes, books = encode(df)
    return with_label_error(codes).select("vec_id", "code", "error", "label_error",
                                          F.lit(books.sha256()).alias("codebooks_sha256"))


def oracle(parts: int = 8, entries: int = 16, scale: int = 4096, rounds: int = 6) -> str:
    """The same rows in DuckDB SQL: one block of common tables a round (vectors whose length the parts divide)."""
    sql = [f"""WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, label, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS q
FROM kept, range({parts}) AS t(p)),
b0 AS MATERIALIZED (SELECT p, e, q FROM (SELECT p, q, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM x)
WHERE e < {entries})"""]
    for r in range(rounds + 1):
        sql.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, label, p, q, (min(d * {entries} + e) % {entries})::BIGINT AS e,
min(d) AS d FROM (SELECT vec_id, label, x.p, x.q, e, list_sum(list_transform(list_zip(x.q, b.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
FROM x JOIN b{r} AS b ON x.p = b.p) GROUP BY vec_id, label, p, q)""")
        if r < rounds:
            sql.append(f"""m{r} AS (SELECT p, e, list(m ORDER BY i) AS q FROM (SELECT p, e, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS m
FROM (SELECT p, e, i, sum(c) AS s, count(*) AS n FROM (SELECT p, e, unnest(q) AS c, unnest(range(len(q))) AS i FROM a{r})
GROUP BY p, e, i)) GROUP BY p, e),
b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.q, b.q) AS q FROM b{r} AS b LEFT JOIN m{r} AS m ON b.p = m.p AND b.e = m.e)""")
    return ",\n".join(sql) + f""",
codes AS (SELECT vec_id, label, string_agg(lpad(to_hex(e), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
FROM a{rounds} GROUP BY vec_id, label),
books AS (SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes, books"""
