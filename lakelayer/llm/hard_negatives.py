"""Hard negatives by angular triangle filtering.

Every row stores its norm and its angles to a few reference directions. For two rows with angles a and b to one direction,
the angle between them lies between |a - b| and min(a + b, 2 pi - a - b), so their cosine lies between cos(a + b) and
cos(|a - b|); over all directions the narrowest interval counts. Multiplied by both norms and widened beyond rounding, it
bounds the integer score. Only rows whose interval overlaps what an anchor still looks for are scored, in integers.

Two passes, each joining blocks of anchors with blocks of rows (an anchor is a stated query against all rows; a block holds
a fixed number of them):

1. positives: the best rows of the anchor's label. What is looked for is a score no lower than the anchor's
   last positive so far.
2. negatives: for each positive a window of scores (``low`` to ``high`` hundredths of the positive's), the best rows of another label in it.
   What is looked for is the union of the windows, cut below at each window's last find so far.

Rows are sorted by label, nearest reference direction and angle before they are cut into blocks, so a block has narrow
ranges of angles and norms; a pair of blocks whose interval cannot matter is left out by the join's condition. Each
task sends its best few rows per anchor, and an aggregate keeps the best of all tasks. Nothing of the rows reaches
the driver but the sample (at most ``sample_rows``) from which the reference directions are chosen; that choice changes speed only,
never a result.

Defined results: rows with a null id, a null label, a null vector, or a null or non-finite component take no part. Rows that
repeat an id are rows like any other (each is an anchor of its own), but a row is never a positive of an anchor with its
id. A shorter vector counts as filled with zeros. Equal scores are ordered by id. An anchor without positives, or a positive
without a row in its window (a negative score leaves none), has no result row. An empty table gives an empty result. Other
columns are ignored, whatever their names. A vector whose integer norm reaches 2**28 raises an error, because scores would
not fit into a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from lakelayer.llm.common import col, small_batches, stored
from lakelayer.llm.vectors import as_doubles, quantised, smallest_ids, usable

COSINE_SLACK = 1e-5      # stored angles are float32: each errs by less than 1e-6, their cosines by less than that
BLOCK = ("block long, n int, width int, ids binary, labels binary, norms binary, angles binary, vectors binary, "
         "label_min long, label_max long, norm_min double, norm_max double, angle_min array<double>, angle_max array<double>")


def _measure(df: DataFrame, scale: int, refs: np.ndarray) -> DataFrame:
    """(vec_id, label, cell, first, norm, angles, q) of every row: cell is the nearest reference direction."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = quantised(b.column("v"), scale, refs.shape[1])
            norm = np.linalg.norm(q, axis=1)
            if len(q) and norm.max() >= 2.0 ** 28:
                raise ValueError("a vector's integer norm reaches 2**28; use a smaller scale")
            unit = q / np.where(norm > 0, norm, 1)[:, None]
            angles = np.arccos(np.clip(unit[:, :refs.shape[1]] @ refs.T, -1, 1)).astype("<f4")
            cell = angles.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(cell.astype(np.int32)),
                 pa.array(angles[np.arange(len(q)), cell]), pa.array(norm),
                 pa.array([a.tobytes() for a in angles], pa.binary()),
                 pa.array([r.tobytes() for r in q.astype("<i4")], pa.binary())],
                ["vec_id", "label", "cell", "first", "norm", "angles", "q"])
    return df.mapInArrow(run, "vec_id long, label long, cell int, first float, norm double, angles binary, q binary")


def _blocks(measured: DataFrame, size: int, directions: int) -> DataFrame:
    """Rows in order, cut into blocks of at most ``size`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for at in range(0, b.num_rows, size):
                x, number = b.slice(at, size), number + 1
                rows = [np.frombuffer(v, "<i4") for v in x.column("q").to_pylist()]
                width = max(map(len, rows))
                vectors = np.zeros((len(rows), width), "<i4")
                for i, v in enumerate(rows):
                    vectors[i, :len(v)] = v
                label, norm = x.column("label").to_numpy(), x.column("norm").to_numpy()
                angles = np.frombuffer(b"".join(x.column("angles").to_pylist()), "<f4").reshape(len(rows), directions)
                yield pa.RecordBatch.from_pylist([{
                    "block": number, "n": len(rows), "width": width, "ids": x.column("vec_id").to_numpy().tobytes(),
                    "labels": label.tobytes(), "norms": norm.tobytes(), "angles": angles.tobytes(), "vectors": vectors.tobytes(),
                    "label_min": int(label.min()), "label_max": int(label.max()),
                    "norm_min": float(norm.min()), "norm_max": float(norm.max()),
                    "angle_min": angles.min(0).astype(float).tolist(), "angle_max": angles.max(0).astype(float).tolist(),
                }], schema=arrow)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(StructType.fromDDL(BLOCK))
    order = ["label", "cell", "first", "vec_id"]
    return measured.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, BLOCK)


def reference_directions(vectors: np.ndarray, n: int) -> np.ndarray:
    """Unit directions of ``n`` farthest-first rows (fewer if there are no more different ones; at least one)."""
    norm = np.linalg.norm(vectors, axis=1)
    unit = vectors[norm > 0] / norm[norm > 0][:, None]
    if not len(unit):
        return np.eye(1, max(1, vectors.shape[1]))
    chosen = [0]
    near = unit @ unit[0]
    while len(chosen) < n and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    return unit[chosen]


def _block_bounds(directions: int) -> tuple[Column, Column]:
    """Least and greatest score that a row of block r can have with an anchor of block a, from their ranges alone."""
    low, high = [], []
    for k in range(directions):
        a0, a1 = F.col("a.angle_min")[k], F.col("a.angle_max")[k]
        r0, r1 = F.col("r.angle_min")[k], F.col("r.angle_max")[k]
        high.append(F.cos(F.greatest(F.lit(0.0), r0 - a1, a0 - r1)))
        low.append(F.when((a0 + r0 <= np.pi) & (a1 + r1 >= np.pi), F.lit(-1.0))
                   .otherwise(F.least(F.cos(a0 + r0), F.cos(a1 + r1))))
    top = (F.least(*high) if directions > 1 else high[0]) + COSINE_SLACK
    bottom = (F.greatest(*low) if directions > 1 else low[0]) - COSINE_SLACK
    least, most = F.col("a.norm_min") * F.col("r.norm_min"), F.col("a.norm_max") * F.col("r.norm_max")
    return F.least(bottom * least, bottom * most) - 1, F.greatest(top * least, top * most) + 1


class _Block:
    """The arrays of row ``i`` of a batch of pairs, on side "a" (anchors) or "r"."""

    def __init__(self, b: pa.RecordBatch, i: int, side: str, directions: int):
        get = lambda name, kind: np.frombuffer(b.column(f"{side}_{name}")[i].as_buffer(), kind)
        self.ids, self.labels, self.norms = get("ids", "<i8"), get("labels", "<i8"), get("norms", "<f8")
        n = len(self.ids)
        angles = get("angles", "<f4").astype(np.float64).reshape(n, directions).T
        self.cos, self.sin = np.cos(angles), np.sin(angles)                     # direction x row
        self.vectors = get("vectors", "<i4").reshape(n, b.column(f"{side}_width")[i].as_py()).astype(np.float64)

    def bounds(self, anchor: _Block, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of every row with the anchor's row i."""
        c, s = self.cos * anchor.cos[:, i:i + 1], self.sin * anchor.sin[:, i:i + 1]
        size = self.norms * anchor.norms[i]
        return (((c - s).max(0) - COSINE_SLACK) * size - 1, ((c + s).min(0) + COSINE_SLACK) * size + 1)

    def scores(self, anchor: _Block, i: int, rows: np.ndarray) -> np.ndarray:
        """Exact integer scores of the chosen rows."""
        width = min(self.vectors.shape[1], anchor.vectors.shape[1])
        one, many = anchor.vectors[i, :width], self.vectors[rows, :width]
        if len(rows) and self.norms[rows].max() * anchor.norms[i] < 2.0 ** 52:
            return (many @ one).astype(np.int64)          # every partial sum is an integer below 2**53: exact
        return many.astype(np.int64) @ one.astype(np.int64)


class _Best:
    """The first ``keep`` (score, id) pairs seen, higher scores first, then smaller ids."""

    def __init__(self, keep: int):
        self.keep, self.scores, self.ids = keep, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def floor(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.keep else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[:self.keep]
        self.scores, self.ids = scores[order], ids[order]


def _scan(pairs: DataFrame, directions: int, keep: int, window: tuple[int, int] | None = None) -> DataFrame:
    """(block, anchor, anchor_id, slot, score, vec_id): the best rows that a task finds for each anchor and slot. Without a
    window there is one slot and rows of the anchor's label count; with one there is a slot for each positive's score,
    and rows of other labels within these hundredths of it count."""
    def look(best: list[list[_Best]], a: _Block, r: _Block, ranges: list) -> None:
        for i in range(len(a.ids)):
            low, high = r.bounds(a, i)
            if window is None:
                rows = np.flatnonzero((r.labels == a.labels[i]) & (r.ids != a.ids[i]) & (high >= best[i][0].floor))
                best[i][0].add(r.scores(a, i, rows), r.ids[rows])
                continue
            wanted = np.zeros(len(r.ids), bool)
            for mine, (least, most) in zip(best[i], ranges[i]):
                wanted |= (high >= max(least, mine.floor)) & (low <= most)
            rows = np.flatnonzero(wanted & (r.labels != a.labels[i]))
            scores = r.scores(a, i, rows)
            for mine, (least, most) in zip(best[i], ranges[i]):
                inside = (scores >= least) & (scores <= most)
                mine.add(scores[inside], r.ids[rows[inside]])

    def out(block: int, a: _Block, best: list[list[_Best]]) -> pa.RecordBatch:
        found = [(block, i, int(a.ids[i]), s, score, row) for i, slots in enumerate(best) for s, b in enumerate(slots)
                 for score, row in zip(b.scores.tolist(), b.ids.tolist())]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*found)) or [()] * 6, kinds)],
                                          ["block", "anchor", "anchor_id", "slot", "score", "vec_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, a, best, ranges = None, None, [], []
        for b in batches:
            for i in range(b.num_rows):
                if b.column("a_block")[i].as_py() != block:
                    if block is not None:
                        yield out(block, a, best)
                    block, a = b.column("a_block")[i].as_py(), _Block(b, i, "a", directions)
                    ranges = [[(0, 0)]] * len(a.ids)
                    if window is not None:
                        ranges = [[] for _ in a.ids]
                        for x in b.column("a_asked")[i].as_py():
                            ranges[x["anchor"]] = [(-(-window[0] * p // 100), window[1] * p // 100) for p in x["scores"]]
                    best = [[_Best(keep) for _ in slots] for slots in ranges]
                look(best, a, _Block(b, i, "r", directions), ranges)
        if block is not None:
            yield out(block, a, best)

    return pairs.mapInArrow(run, "block long, anchor int, anchor_id long, slot int, score long, vec_id long")


def _first(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` rows of every (block, anchor, slot), in order; at most ``keep`` a task come in for each."""
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("neg"), "vec_id")))
    return (found.groupBy("block", "anchor", "anchor_id", "slot").agg(F.slice(ordered, 1, keep).alias("x"))
            .withColumn("x", F.transform("x", lambda x: F.struct((-x["neg"]).alias("score"), x["vec_id"].alias("vec_id")))))


def _pairs(anchors: DataFrame, rows: DataFrame, condition: Column, extra: tuple[str, ...] = ()) -> DataFrame:
    """Blocks of anchors against blocks of rows. Stated as a replicated nested loop, so that no side is broadcast: a task
    holds one part of each stored table."""
    names = ["n", "width", "ids", "labels", "norms", "angles", "vectors"]
    return (anchors.alias("a").hint("shuffle_replicate_nl").join(rows.alias("r"), condition)
            .select(F.col("a.block").alias("a_block"), *[F.col(f"a.{c}").alias(f"a_{c}") for c in (*names, *extra)],
                    *[F.col(f"r.{c}").alias(f"r_{c}") for c in names]))


def mine(df: DataFrame, anchors: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", *,
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, directions: int = 8,
         sample_rows: int = 1024, block_rows: int = 2048, anchor_rows: int = 256) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` (a condition on df's columns) chooses; ``label`` is an integer
    expression on df's columns. Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    ``scale`` is a power of two."""
    spark = df.sparkSession
    small_batches(spark, rows=block_rows)
    rows = df.select(col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                     F.when(usable(vec_col), as_doubles(vec_col)).alias("v"), F.coalesce(anchors, F.lit(False)).alias("chosen"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    sample = [r["v"] for r in smallest_ids(rows.select("vec_id", "v"), "vec_id", sample_rows)]
    width = max(map(len, sample), default=1)
    refs = reference_directions(np.array([v + [0.0] * (width - len(v)) for v in sample]).reshape(len(sample), width), directions)
    n_refs = len(refs)

    blocks = stored(_blocks(_measure(rows.select("vec_id", "label", "v"), scale, refs), block_rows, n_refs), "negatives-rows")
    asked = stored(_blocks(_measure(rows.where("chosen").select("vec_id", "label", "v"), scale, refs), anchor_rows, n_refs),
                   "negatives-anchors")

    same = (F.col("a.label_min") <= F.col("r.label_max")) & (F.col("r.label_min") <= F.col("a.label_max"))
    best = stored(_first(_scan(_pairs(asked, blocks, same), n_refs, positives), positives), "negatives-positives")

    scores = F.transform("x", lambda p: p["score"])
    per_block = (best.withColumn("scores", scores).groupBy("block")
                 .agg(F.collect_list(F.struct("anchor", "scores")).alias("asked"),
                      F.min(F.array_min("scores") * (low / 100)).alias("least"),
                      F.max(F.array_max("scores") * (high / 100)).alias("most")))
    seeking = stored(asked.join(per_block, "block"), "negatives-windows")
    bottom, top = _block_bounds(n_refs)
    one_label = ((F.col("a.label_min") == F.col("a.label_max")) & (F.col("r.label_min") == F.col("r.label_max"))
                 & (F.col("a.label_min") == F.col("r.label_min")))
    condition = ~one_label & (top >= F.col("a.least") - 1) & (bottom <= F.col("a.most") + 1)
    found = _first(_scan(_pairs(seeking, blocks, condition, ("asked",)), n_refs, negatives, (low, high)), negatives)

    chosen = best.select("block", "anchor", F.posexplode("x").alias("slot", "p"))
    return (found.select("block", "anchor", "anchor_id", "slot", F.posexplode("x").alias("rank", "neg"))
            .join(chosen, ["block", "anchor", "slot"])
            .select("anchor_id", F.col("p.vec_id").alias("positive_id"), (F.col("rank") + 1).cast("int").alias("rank"),
                    F.col("neg.vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"),
                    F.col("neg.score").alias("negative_score")))


def hard_negative_query(df: DataFrame) -> DataFrame:
    """Anchors: ids divisible by 100. Ids divisible by 7 first move on to the next label of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(df, F.col("vec_id") % 100 == 0, label)


ORACLE = """
WITH kept AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
  list_inner_product(a.v, r.v)::BIGINT AS score
  FROM kept AS a JOIN kept AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
