"""Property test: SCD2 (plain and track-except, split path forced) against brute force."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakelayer.operators.scd import END_AT, START_AT, scd2_apply

rows_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 20000), st.sampled_from("ab"),
                             st.integers(0, 9)),
                   min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1]))


def brute(rows, track_v_only: bool):
    out = []
    for k in sorted({r[0] for r in rows}):
        rs = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        if not track_v_only:
            for i, r in enumerate(rs):
                out.append((k, r[1], r[2], r[3], r[1], rs[i + 1][1] if i + 1 < len(rs) else None))
            continue
        islands = []
        for r in rs:
            if islands and islands[-1][-1][2] == r[2]:
                islands[-1].append(r)
            else:
                islands.append([r])
        for i, isl in enumerate(islands):
            last = isl[-1]
            nxt = islands[i + 1][0][1] if i + 1 < len(islands) else None
            out.append((k, last[1], last[2], last[3], isl[0][1], nxt))
    return sorted(out)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st, track=st.booleans())
def test_scd2_matches_brute_force(spark, rows, track):
    df = spark.createDataFrame(rows, "k int, seq long, v string, w int")
    spark.conf.set("lakelayer.segmentCuts", "9")         # most keys hold cuts
    try:
        got = scd2_apply(df, ["k"], "seq", track_except=["seq", "w"] if track else None)
        got = sorted(tuple(r) for r in got.select("k", "seq", "v", "w", START_AT, END_AT).collect())
    finally:
        spark.conf.unset("lakelayer.segmentCuts")
    assert got == brute(rows, track)


rows1_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.sampled_from(["a", "b", "DEL"])),
                    min_size=1, max_size=30)


def brute_scd1(rows):
    out = {}
    for k in {r[0] for r in rows}:
        best = max((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))   # seq, then greatest row
        if best[2] != "DEL":
            out[k] = best
    return sorted(out.values())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows1_st)
def test_scd1_matches_brute_force(spark, rows):
    from lakelayer.operators.scd import scd1_apply
    df = spark.createDataFrame(rows, "k int, seq int, v string")
    got = sorted(tuple(r) for r in scd1_apply(df, ["k"], ["seq"], delete_when="v = 'DEL'").collect())
    assert got == brute_scd1(rows)


snap_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 8), st.sampled_from("pq")),
                   min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1]))


def brute_hash_history(rows):
    import datetime as dt
    base = dt.date(2024, 1, 1)
    out = []
    for k in sorted({r[0] for r in rows}):
        rs = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        starts = [r for i, r in enumerate(rs) if i == 0 or rs[i - 1][2] != r[2]]
        for i, r in enumerate(starts):
            nxt = starts[i + 1][1] if i + 1 < len(starts) else None
            out.append((str(k), r[2], base + dt.timedelta(days=r[1]),
                        None if nxt is None else base + dt.timedelta(days=nxt - 1), nxt is None, i + 1))
    return sorted(out, key=str)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=snap_st)
def test_hash_history_matches_brute_force(spark, rows):
    import datetime as dt
    from lakelayer.functions import record_hash
    from lakelayer.operators.scd import scd2_hash_history
    base = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(str(k), v, base + dt.timedelta(days=d)) for k, d, v in rows],
                               "id string, v string, ingest_date date")
    df = df.withColumn("record_hash", record_hash(df))
    spark.conf.set("lakelayer.segmentCuts", "9")         # most keys hold cuts
    try:
        got = scd2_hash_history(df, "id").select("id", "v", "effective_start_date", "effective_end_date",
                                                 "is_current", "record_version").collect()
    finally:
        spark.conf.unset("lakelayer.segmentCuts")
    assert sorted((tuple(r) for r in got), key=str) == brute_hash_history(rows)
