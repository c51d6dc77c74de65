import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

CALLS = "LAKELAYER_TEST_CALLS"


def api(url):
    """A paged API of three pages per request, one resource of which sends a broken body; logs every call."""
    with open(os.environ[CALLS], "a") as f:
        f.write(url + "\n")
    if "Broken" in url:
        return '{"entry": ['
    page = int(url.partition("&_page=")[2] or 1)
    link = [{"relation": "next", "url": url.partition("&_page=")[0] + f"&_page={page + 1}"}] if page < 3 else []
    return json.dumps({"total": 6, "entry": [1, 2], "link": link})


def module(tmp_path, spark, monkeypatch):
    """The same API as a module that Python workers import, with the log's place written into it."""
    name = f"paged_api_{os.path.basename(str(tmp_path)).replace('-', '_')}"
    src = open(__file__).read().split("def module(")[0].split("CALLS =", 1)[1]
    path = tmp_path / f"{name}.py"
    path.write_text("import json\nimport os\nCALLS =" + src.replace("os.environ[CALLS]", repr(str(tmp_path / "calls"))))
    spark.sparkContext.addPyFile(str(path))
    return f"{name}:api"


def test_broken_body_is_a_failed_row(spark, tmp_path, monkeypatch):
    from lakelayer.sources.paged import fetch_pages
    got = fetch_pages(spark, "http://x", "2024-01-01", "2024-01-02", module(tmp_path, spark, monkeypatch),
                      resources=["Broken", "Patient"], retry_pause_s=0.0).collect()
    assert sorted((r.resource, r.page_number, r.status) for r in got) == [("Broken", 1, "failed"), ("Patient", 1, "success"),
                                                                         ("Patient", 2, "success"), ("Patient", 3, "success")]
    assert next(r for r in got if r.resource == "Broken").body == '{"entry": ['


def test_crawl_resumes_between_pages_and_fetches_nothing_twice(spark, scratch, tmp_path, monkeypatch):
    from lakelayer.sources import paged
    transport, root = module(tmp_path, spark, monkeypatch), scratch("crawl")
    days = spark.createDataFrame([(r, dt.date(2024, 1, d), f"http://x/{r}?d={d}") for r in ("Patient", "Encounter", "Broken")
                                  for d in (1, 2)], "resource string, day date, url string")
    from pyspark.sql.classic.dataframe import DataFrame
    left, is_empty = [0], DataFrame.isEmpty

    def dies(self):
        left[0] += 1
        if left[0] == 2:
            raise RuntimeError("killed after the second page of every request")
        return is_empty(self)
    monkeypatch.setattr(DataFrame, "isEmpty", dies)
    with pytest.raises(Exception):
        paged.crawl(spark, days, root, transport, tasks=2, retry_pause_s=0.0)
    log = (tmp_path / "calls").read_text().split()
    assert len([u for u in log if "Broken" not in u]) == 8
    monkeypatch.undo()
    got = paged.crawl(spark, days, root, transport, tasks=2, retry_pause_s=0.0)
    assert sorted((r.resource, r.day.day, r.page_number, r.status) for r in got.collect()) == sorted(
        [(r, d, p, "success") for r in ("Patient", "Encounter") for d in (1, 2) for p in (1, 2, 3)]
        + [("Broken", d, 1, "failed") for d in (1, 2)])
    log = [u for u in (tmp_path / "calls").read_text().split() if "Broken" not in u]
    assert len(log) == len(set(log)) == 12
    assert paged.crawl(spark, days, root, transport, tasks=2).count() == 14
    assert len((tmp_path / "calls").read_text().split()) == 12 + 2 * paged.MAX_RETRIES


@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(20,3)", "date", "timestamp_ntz"])
def test_range_join_matches_nested_loop(spark, kind):
    from lakelayer.operators.ranges import range_join
    rng = random.Random(len(kind))
    point = lambda: None if rng.random() < 0.05 else rng.choice([0, 7, -3, rng.randint(-5000, 5000)])
    cast = {"date": "date_add(DATE'2024-01-01', CAST({0} AS int))",
            "timestamp_ntz": "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, {0}, 0.5)"}.get(kind, "CAST({0} AS " + kind + ")")
    facts = spark.createDataFrame([(i, point(), i % 3) for i in range(300)], "id int, x int, g int")
    facts = facts.withColumn("v", F.expr(cast.format("x"))).alias("f")
    spans = spark.createDataFrame([(i, a, None if a is None else a + rng.choice([-5, 0, 1, 1, 3, 40, 9000]), i % 3)
                                   for i, a in enumerate(point() for _ in range(60))], "sid int, a int, b int, h int")
    spans = spans.withColumns({"lo": F.expr(cast.format("a")), "hi": F.expr(cast.format("b"))})
    for how in ("left", "inner"):
        for cond in (None, F.expr("f.g = s.h")):
            got = range_join(facts, spans, F.expr("f.v"), F.expr("s.lo"), F.expr("s.hi"), "s", cond, how).select("f.id", "s.sid")
            on = F.expr("s.lo <= f.v AND f.v < s.hi" + ("" if cond is None else " AND f.g = s.h"))
            want = facts.join(spans.alias("s"), on, how).select("f.id", "s.sid")
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        range_join(facts, spans, F.lit("x"), F.expr("s.lo"), F.expr("s.hi"), "s")


def test_star_select_list_takes_expressions(spark):
    from lakelayer.operators.star import JoinSpec, star_join
    frames = {"f": spark.createDataFrame([(1, None, "a,b")], "k int, n string, t string"),
              "d": spark.createDataFrame([(1, "x")], "k int, n string")}
    got = star_join(spark, [JoinSpec("f", "f", "f.k, coalesce(f.n, 'none, yet') AS n, split(f.t, ',')[1] part"),
                            JoinSpec("d", "d", "d.n AS dn, concat(d.n, '(')  AS odd", "f.k = d.k")], frames)
    assert [tuple(r) for r in got.collect()] == [(1, "none, yet", "b", "x", "x(")] and got.columns == ["k", "n", "part", "dn", "odd"]


def test_schema_records_grow_and_guard_types(spark, scratch):
    from lakelayer.sinks.schemas import conform, grow_schema, stored_schema
    at = scratch("schema")
    assert stored_schema(spark, at) is None
    grow_schema(spark, at, spark.createDataFrame([], "a long, b string").schema)
    grown = grow_schema(spark, at, spark.createDataFrame([], "B string, c double").schema)
    assert grown.names == ["a", "b", "c"] == stored_schema(spark, at).names
    assert len(spark.read.json(at).collect()) == 2 and grow_schema(spark, at, grown) == grown and len(spark.read.json(at).collect()) == 2
    got = conform(spark.createDataFrame([(1, 2)], "c int, a int"), grown)
    assert got.columns == ["a", "b", "c"] and tuple(got.first()) == (2, None, 1.0)
    with pytest.raises(ValueError, match="column a"):
        conform(spark.createDataFrame([("x",)], "a string"), grown)


def test_replayed_history_follows_any_order_of_loads(spark, scratch):
    from lakelayer.functions import record_hash
    from lakelayer.operators.scd import scd2_hash_history
    from lakelayer.sinks.history import ReplayedHistory, read_history, replay
    rng = random.Random(4)
    days = [dt.date(2024, 1, d) for d in range(1, 7)]

    def snap(rows):
        df = spark.createDataFrame(rows, "id string, v string, ingest_date date")
        return df.withColumn("record_hash", record_hash(df))

    rows = [(f"k{i}", rng.choice("ab"), d) for d in days for i in range(8) if rng.random() < 0.8] + [(None, "a", days[0])]
    h = ReplayedHistory(scratch("history"), "id", buckets=2)
    states = [[r for r in rows if r[2] in (days[1], days[4])], [r for r in rows if r[2] != days[2]],
              [r if r[2] != days[3] else (r[0], "wrong", r[2]) for r in rows], rows, [r for r in rows if r[2] != days[0]]]
    clock = lambda d: F.to_timestamp(d)
    cols = ["id", "v", "effective_start_date", "effective_end_date", "is_current", "record_version", "silver_load_timestamp"]
    for state in states:
        changed = replay(spark, h, snap(state), clock)
        want = scd2_hash_history(snap(state).where("id IS NOT NULL"), "id", clock=clock).select(cols)
        assert changed and sorted(map(str, read_history(spark, h).select(cols).collect())) == sorted(map(str, want.collect()))
    assert replay(spark, h, snap(states[-1]), clock) == []
