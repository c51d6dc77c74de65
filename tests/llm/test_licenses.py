"""The licence scan against a brute-force version in Python: positions, suppression, ties, empty and long texts."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from lakelayer.llm import licenses
from lakelayer.llm.license_rules import CONFIDENCE, RULES, Rule, compile_rule
from lakelayer.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"
EDGE = [(1, None), (2, ""), (3, " \n--"), (4, "MIT License"), (5, "MIT License"), (5, "MIT License"), (None, "CC BY"),
        (6, "x" * 100_000), (7, "mit license x " * 1500), (8, "Licensed under the Apache License, Version 2.0."),
        (9, "CC-BY-NC 4.0 / CC BY-SA 4.0; cc by"), (10, "mıt License MİT LICENSE mit\tlicense"),
        (11, "GNU General Public License, version 3. SPDX-License-Identifier: GPL-3.0-or-later"),
        (12, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal " + "in it " * 30 + "WARRANTIES OF MERCHANTABILITY"),
        (13, "the public domain dedication and license; public domain"), (14, "$1 \x01 mit license \x02 \\ cc by")]


def brute(text, rules=RULES):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    norm = "".join(f" {w}" for w in words)
    finds = []
    for r in rules:
        for m in re.finditer(r.regex, norm):
            finds.append((norm[:m.start()].count(" "), norm[:m.end()].count(" "), r.tier, r.order, r.label))
    left = [d for d in finds if not any(e != d and e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2]
                                        and (e[:2] != d[:2] or e[2] < d[2] or e[3] < d[3]) for e in finds)]
    return len(words), finds, left


def expected(doc_id, text):
    n, finds, left = brute(text)
    base = [f for f in finds if f[2] == 1]
    starts = [f[0] for f in base]
    both = base + left
    names = lambda x: ",".join(sorted({f[4] for f in x}))
    return (doc_id, n, len(base), min(starts, default=None), max(starts, default=None), names(base), names(both),
            max((CONFIDENCE[f[2]] for f in both), default=0.0))


def test_rules_are_well_formed():
    assert len(RULES) > 300 and len({r.order for r in RULES}) == len(RULES)
    for r in RULES:
        assert re.search(rf"(?<![a-z0-9]){r.keyword}(?![a-z0-9])", r.regex), r
        assert not re.search(rf"\(\?:[^)]*{r.keyword}[^)]*\)\?", r.regex), r        # the keyword is never optional


def test_edge_texts_match_brute_force(spark):
    rows = [r for r in EDGE if r[0] != 7]
    df = (spark.createDataFrame(rows, SCHEMA).repartition(3)
          .withColumns({"finds": F.lit(1), "_norm": F.lit("mit license"), "base": F.lit(2.0), "n_words": F.lit(None).cast("int")}))
    got = licenses.license_query(df).collect()
    assert Counter(map(tuple, got)) == Counter(expected(*r) for r in rows)
    assert licenses.license_query(df.where("false")).collect() == []


def test_many_finds_in_one_text(spark):
    got = licenses.license_query(spark.createDataFrame([EDGE[8]], SCHEMA)).first()
    assert (got["n_base"], got["first_word"], got["last_word"], got["labels"]) == (1500, 0, 4497, "mit")
    left = licenses.scan(spark.createDataFrame([EDGE[8]], SCHEMA)).select(F.size("detections")).first()[0]
    assert left == 1500


def test_spans_of_overlapping_rules(spark):
    rules = [Rule(0, 1, "b", "base", compile_rule("b")), Rule(1, 2, "a", "text", compile_rule("a b c")),
             Rule(2, 3, "a", "longer", compile_rule("a b c d")), Rule(3, 3, "c", "inside", compile_rule("c d")),
             Rule(4, 3, "c", "tie", compile_rule("c d")), Rule(5, 4, "d", "beyond", compile_rule("d W{0,2} f")),
             Rule(6, 2, "e", "none", compile_rule("e e"))]
    texts = ["a b c d e f", "b", "c d", "a b c", "d f d x f d x y f d x y z f", "c d c d", "e e e e", "x a b c d c d"]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for row in licenses.scan(df, rules=rules).collect():
        n, finds, left = brute(texts[row["doc_id"]], rules)
        assert row["n_words"] == n and Counter(map(tuple, row["finds"])) == Counter(finds)
        assert Counter(map(tuple, row["detections"])) == Counter(left), texts[row["doc_id"]]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_matches_brute_force(spark, sf):
    got = Counter(map(tuple, QUERIES["op12_license_scan"](spark, sf).collect()))
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    assert got == Counter(expected(*r) for r in rows)


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op12_license_scan"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
