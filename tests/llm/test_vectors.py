"""Vector codes and hard negatives against brute force: ties, nulls, repeated rows, clashing names, empty tables."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakelayer.llm import hard_negatives, vector_codes
from lakelayer.llm.vector_codes import Gnat

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n=400, dim=16, seed=3, hot=0):
    r = random.Random(seed)
    near = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(10)]
    rows = []
    for i in range(n):
        lab = r.randrange(10)
        v = near[0] if i < hot else [near[lab][k] * 0.6 + r.gauss(0, 0.7) for k in range(dim)]
        rows.append((i * 5, [float(np.float32(x)) for x in v], 1 if i < hot else lab))
    return rows


EDGE = [(7001, None, 1), (7002, [1.0] * 15 + [None], 2), (7003, [float("nan")] * 16, 2), (7100, [float("inf")] * 16, None),
        (7200, [0.0] * 16, None), (7004, [0.25] * 16, None), (7004, [0.25] * 16, None), (7300, [0.5] * 16, None),
        (7005, [-1.0] * 16, 4)]


def frame(spark, rows, parts=3):
    return (spark.createDataFrame(rows, SCHEMA).repartition(parts)
            .withColumns({"score": F.lit("x"), "code": F.lit(1), "q": F.lit(2.5), "rank": F.lit(None).cast("int")}))


def usable(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]


# ---- 13 vector codes ----

def brute_codes(rows, parts=8, entries=16, rounds=6):
    rows = sorted(usable(rows), key=lambda r: r[0])
    x = np.floor(4096 * np.array([r[1] for r in rows])).astype(np.int64).reshape(len(rows), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assign():
        d = ((x[:, :, None] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)
    for _ in range(rounds):
        index, _ = assign()
        new = books.copy()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[index[:, p] == e, p]
                if len(mine):
                    new[p, e] = mine.sum(0) // len(mine)
        books = new
    index, d = assign()
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    total = defaultdict(int)
    for r, e in zip(rows, d.sum(1)):
        total[r[2]] += int(e)
    return Counter((r[0], "".join(f"{i:02x}" for i in c), int(e), total[r[2]], sha) for r, c, e in zip(rows, index, d.sum(1)))


@pytest.mark.parametrize("rows", [vectors() + EDGE, vectors(hot=150), vectors(9), EDGE], ids=["mixed", "hot", "few", "edge"])
def test_codes_match_brute_force(spark, rows):
    got = vector_codes.vector_codes_query(frame(spark, rows))
    assert Counter(map(tuple, got.collect())) == brute_codes(rows)


def test_codes_of_nothing_and_of_uneven_vectors(spark):
    got = vector_codes.vector_codes_query(frame(spark, []))
    assert got.collect() == [] and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    uneven = [(1, [0.5] * 5, 1), (2, [0.5] * 3, 1), (3, [], 2), (None, [1.0], 2)]
    padded = [(i, v + [0.0] * (8 - len(v)), lab) for i, v, lab in uneven]
    got = vector_codes.vector_codes_query(frame(spark, uneven)).collect()
    want = vector_codes.vector_codes_query(frame(spark, padded)).collect()
    assert Counter(got) == Counter(want) and len(got) == 4 and {r["error"] for r in got} == {0}


@pytest.mark.parametrize("m, degree, spread", [(16, 4, 50), (200, 4, 3), (256, 8, 400), (1, 4, 5), (30, 2, 1)])
def test_tree_finds_the_lowest_nearest_entry(m, degree, spread):
    r = np.random.default_rng(m)
    entries, queries = r.integers(-spread, spread + 1, (m, 4)), r.integers(-spread, spread + 1, (3000, 4))
    index, d2, measured = Gnat(entries, degree).nearest(queries)
    d = ((queries[:, None] - entries[None]) ** 2).sum(2)
    assert (index == d.argmin(1)).all() and (d2 == d.min(1)).all()
    if spread == 400:
        assert measured < 0.8 * d.size                # whole subtrees are left out


def test_too_large_vectors_raise(spark):
    with pytest.raises(Exception, match="norm reaches"):
        vector_codes.encode(frame(spark, [(1, [1e9] * 8, 1)]))


# ---- 11 hard negatives ----

def brute_negatives(rows):
    x = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, np.floor(256 * np.array(v)).astype(np.int64))
         for i, v, lab in usable(rows) if i is not None and lab is not None]
    out = Counter()
    for i, lab, v in x:
        if i % 100:
            continue
        score = lambda w: int(v[:len(w)] @ w[:len(v)])
        scored = sorted((-score(w), j, other == lab) for j, other, w in x if j != i)
        for neg, pos, _ in [s for s in scored if s[2]][:5]:
            p = -neg
            fit = [s for s in scored if not s[2] and 30 * p <= -100 * s[0] <= 90 * p][:10]
            out.update((i, pos, k + 1, j, p, -n) for k, (n, j, _) in enumerate(fit))
    return out


@pytest.mark.parametrize("sizes", [dict(), dict(block_rows=7, anchor_rows=3, directions=3), dict(directions=1, sample_rows=1)])
@pytest.mark.parametrize("rows", [vectors() + EDGE, vectors(hot=150), vectors(500, dim=2, seed=5) + [(900, [], 1), (None, [1.0], 1)],
                                  EDGE], ids=["mixed", "hot", "flat", "edge"])
def test_negatives_match_brute_force(spark, rows, sizes):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 100 == 0, label, **sizes)
    assert Counter(map(tuple, got.collect())) == brute_negatives(rows)


def test_negatives_of_nothing(spark):
    got = hard_negatives.hard_negative_query(frame(spark, []))
    assert got.collect() == [] and dict(got.dtypes)["rank"] == "int"


def test_bounds_hold_every_score():
    r = np.random.default_rng(1)
    v = np.floor(256 * r.normal(size=(300, 6)))
    v[:20] = v[0]
    v[20] = 0
    refs = hard_negatives.reference_directions(v[:50], 5)
    norm = np.linalg.norm(v, axis=1)
    angles = np.arccos(np.clip(v / np.where(norm > 0, norm, 1)[:, None] @ refs.T, -1, 1)).astype("f4").astype(float)
    block = object.__new__(hard_negatives._Block)
    block.norms, block.cos, block.sin, block.vectors = norm, np.cos(angles.T), np.sin(angles.T), v
    for i in range(300):
        low, high = block.bounds(block, i)
        score = block.scores(block, i, np.arange(300))
        assert (low <= score).all() and (score <= high).all()
        assert (high - low)[:20].max() < 0.01 * norm[0] ** 2 or i >= 20
