import datetime as dt

from pyspark.sql import functions as F

from lakelayer.functions import (day_sequence, duration_flag, email_valid, first_elem, hyphen_to_space,
                                 join_words, last_match, or_else, record_hash, strip_ref)


def test_email_shape_and_trailing_newline(spark):
    cases = [("a.b@example.com", True), ("a.b@example.com\n", True), ("a.b@example.com\r\n", False),
             ("no-at.example.com", False), ("x@example.c", False), (None, False), ("x@ex.co\n\n", False)]
    df = spark.createDataFrame(cases, "e string, want boolean")
    got = df.select(email_valid("e").alias("g"), "want").collect()
    assert all(r.g == r.want for r in got)


def test_duration_buckets_boundaries_and_null(spark):
    df = spark.createDataFrame([(149,), (150,), (299,), (300,), (None,)], "d int")
    assert [r.f for r in df.select(duration_flag("d").alias("f")).collect()] == \
        ["low", "medium", "medium", "high", "high"]


def test_hyphen_every_occurrence(spark):
    df = spark.createDataFrame([("a-b-c",), (None,)], "s string")
    assert [r.s for r in df.select(hyphen_to_space("s").alias("s")).collect()] == ["a b c", None]


def test_nested_helpers(spark):
    df = spark.createDataFrame(
        [([], [{"system": "phone", "value": "1"}, {"system": "phone", "value": "2"}], None, "", ["a", "b"]),
         (None, None, "Patient/7", None, []),
         (["x"], [], "https://h/Patient/9", "v", None)],
        "arr array<string>, tel array<struct<system:string,value:string>>, ref string, a string, g array<string>")
    got = df.select(first_elem("arr").alias("f"), last_match("tel", "system", "phone")["value"].alias("p"),
                    strip_ref("ref", "Patient/").alias("r"), or_else("a", F.lit("b")).alias("o"),
                    join_words("g").alias("j")).collect()
    assert [tuple(r) for r in got] == [(None, "2", "", "b", "a b"), (None, None, "7", "b", None),
                                       ("x", None, "https://h/9", "v", None)]


def test_record_hash_ignores_all_null_column_and_metadata(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = a.withColumn("extra", F.lit(None).cast("string")).withColumn("api_url", F.lit("u"))
    ha = a.select(record_hash(a).alias("h")).first().h
    hb = b.select(record_hash(b).alias("h")).first().h
    assert ha == hb and len(ha) == 64
    c = a.withColumn("v", F.lit("y"))
    assert c.select(record_hash(c).alias("h")).first().h != ha


def test_day_sequence_half_open(spark):
    df = spark.range(1)
    got = df.select(day_sequence("2024-01-01", "2024-01-04").alias("a"),
                    day_sequence("2024-01-04", "2024-01-04").alias("b")).first()
    assert got.a == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)] and got.b == []
