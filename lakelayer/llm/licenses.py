"""Licence scan by ordered signature rules, in DataFrame functions only.

A text is lower-cased (A-Z) and its words are set apart by one space. The set of its words, met with the rules' keywords,
decides which rules are tried (``license_rules``): a document without a keyword costs no match. A rule that occurs marks
the first and last words of its matches in the text, and the places of the marks are the word positions. Then one pass over
a document's finds, ordered by first word, longest first, earlier tier, earlier rule, drops every find that lies within an
earlier-ordered one of the same or a better tier; per tier it is enough to carry the greatest end seen.

All of it happens within the document's own row: no shuffle, no group, no key, so a text or phrase that a third of all rows
share changes nothing. Finds are gathered in pieces of 512, so the work grows with their number.

Defined results: a null text counts as empty; a text without words, and an empty table, have no finds. Rows that repeat
an id, and rows with a null id, are rows like any other. Matches of one rule don't overlap one another. Columns beside id
and text may have any names and are left out.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from lakelayer.llm.common import col, text_or_empty
from lakelayer.llm.license_rules import CONFIDENCE, RULES, Rule

# Fixed value: what separates words.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OPEN, CLOSE = "\x01", "\x02"          # marks: separators, so no text holds them once words are set apart
FIND = "struct<first:int,until:int,tier:int,rule:int,label:string>"
PIECE = 512


def _rules(rules: list[Rule]) -> Column:
    """Keyword -> its rules, as one constant map."""
    by: dict[str, list[dict]] = {}
    for r in rules:
        by.setdefault(r.keyword, []).append({"rule": r.order, "tier": r.tier, "label": r.label, "regex": f"({r.regex})"})
    return F.from_json(F.lit(json.dumps(by)), "map<string,array<struct<rule:int,tier:int,label:string,regex:string>>>")


def _found(norm: Column, rule: Column) -> Column:
    """Finds of one rule: the words that open and close a match, paired in order."""
    marked = F.split(F.substring(F.regexp_replace(norm, rule["regex"], F.lit(f" {OPEN}$1{CLOSE}")), 2, 2 ** 31 - 1), " ")
    # " <open> word ... word<close>": an opening mark is a word of its own, taken off the places behind it
    at = F.filter(F.transform(marked, lambda w, i: F.struct(i.alias("i"), (w == OPEN).alias("open"),
                                                            w.endswith(CLOSE).alias("close"))),
                  lambda x: x["open"] | x["close"])
    opened, closed = F.filter(at, lambda x: x["open"]), F.filter(at, lambda x: x["close"])
    return F.zip_with(
        F.transform(opened, lambda x, k: x["i"] - k), F.transform(closed, lambda x, k: x["i"] - k),
        lambda first, until: F.struct(first.cast("int").alias("first"), until.cast("int").alias("until"),
                                      rule["tier"].alias("tier"), rule["rule"].alias("rule"), rule["label"].alias("label")))


def _unsuppressed(finds: Column, tiers: list[int]) -> Column:
    """Finds, in order, that no earlier-ordered find of the same or a better tier holds; ``until`` is exclusive."""
    start = F.struct(F.array(*[F.lit(-1) for _ in tiers]).alias("ends"), F.array().cast(f"array<array<{FIND}>>").alias("done"),
                     F.array().cast(f"array<{FIND}>").alias("last"))

    def step(acc: Column, x: Column) -> Column:
        kept = F.element_at(acc["ends"], x["tier"]) < x["until"]
        full = F.size(acc["last"]) >= PIECE
        one = F.array(x)
        return F.when(kept, F.struct(
            F.transform(acc["ends"], lambda e, i: F.when(i + 1 >= x["tier"], F.greatest(e, x["until"])).otherwise(e)).alias("ends"),
            F.when(full, F.concat(acc["done"], F.array(acc["last"]))).otherwise(acc["done"]).alias("done"),
            F.when(full, one).otherwise(F.concat(acc["last"], one)).alias("last"))).otherwise(acc)

    return F.aggregate(finds, start, step, lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["last"]))))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """One row per document: id, ``n_words``, ``finds`` (every match of every rule) and ``detections`` (what suppression
    leaves). A find: first word, word behind the last, tier, rule number, label; words count from 0. Tiers are 1 to 7."""
    keywords = F.lit(json.dumps(sorted({r.keyword for r in rules})))
    words = F.trim(F.regexp_replace(F.translate(text_or_empty(text_col), UPPER, LOWER), NO_WORD, " "))
    texts = df.select(col(id_col).alias("_id"), words.alias("_norm"))
    texts = texts.select("_id", F.when(F.col("_norm") != "", F.concat(F.lit(" "), "_norm")).otherwise("").alias("_norm"))
    split = F.when(F.col("_norm") != "", F.split(F.substring("_norm", 2, 2 ** 31 - 1), " ")).otherwise(
        F.array().cast("array<string>"))
    gated = (texts.withColumn("_words", split)
             .select("_id", "_norm", F.size("_words").cast("long").alias("_n"),
                     F.array_intersect("_words", F.from_json(keywords, "array<string>")).alias("_hits")))
    by_keyword = _rules(rules)
    tried = F.flatten(F.transform("_hits", lambda k: F.element_at(by_keyword, k)))
    found = F.flatten(F.transform(F.filter(tried, lambda r: F.regexp_like(F.col("_norm"), r["regex"])),
                                  lambda r: _found(F.col("_norm"), r)))
    none = F.array().cast(f"array<{FIND}>")
    finds = gated.select("_id", "_n", F.when(F.size("_hits") > 0, found).otherwise(none).alias("_finds"))

    def before(a: Column, b: Column) -> Column:
        out = F.lit(0)
        for name, up in (("rule", True), ("tier", True), ("until", False), ("first", True)):
            x, y = (a[name], b[name]) if up else (b[name], a[name])
            out = F.when(x < y, -1).when(x > y, 1).otherwise(out)
        return out

    ordered = finds.withColumn("_finds", F.when(F.size("_finds") > 1, F.array_sort("_finds", before)).otherwise(F.col("_finds")))
    tiers = list(range(1, 8))
    left = F.when(F.size("_finds") > 1, _unsuppressed(F.col("_finds"), tiers)).otherwise(F.col("_finds"))
    return ordered.select(F.col("_id").alias(id_col), F.col("_n").alias("n_words"), F.col("_finds").alias("finds"),
                          left.alias("detections"))


def _labels(finds: Column) -> Column:
    return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(finds, lambda x: x["label"]))))


def license_query(df: DataFrame) -> DataFrame:
    """Base places and labels, all labels, and the confidence of the best detection (0 without one)."""
    found = scan(df).withColumn("base", F.filter("finds", lambda x: x["tier"] == 1))
    starts = F.transform("base", lambda x: x["first"].cast("long"))
    confidence = F.array(*[F.lit(CONFIDENCE[t]) for t in sorted(CONFIDENCE)])
    both = F.concat("base", "detections")
    return found.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        _labels(F.col("base")).alias("base_labels"), _labels(both).alias("labels"),
                        F.coalesce(F.array_max(F.transform(both, lambda x: F.element_at(confidence, x["tier"]))),
                                   F.lit(0.0)).alias("score"))
