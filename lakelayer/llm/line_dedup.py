"""Line dedup by deletion neighbourhoods, in DataFrame code.

Of all lines, ordered by (document id, hash of the document's text, line number), a line is removed if an equal line, or
one within one character edit, stands earlier. Every line takes part, however short (``near_length`` can exempt short
ones from the edit); empty lines are never removed.

Two lines within one edit have a deletion variant in common: taking out the same position (a changed character), or the
one line being the other without a character. Variants travel as 128-bit hashed keys with the earliest place per key, so
a key with many lines costs one row per line and no pair is built; a line and its earliest partner are then compared by
edit distance. Which positions can differ is narrowed first: the edit lies in one of m blocks of the line, and the rest
of the line, hashed, must be shared with another line. That step runs on all distinct lines for 2 blocks, on what is
left for 16; it only drops variants that no other line could have. Lines carry their hash instead of their text except
where a partner is possible.

Defined results: a null text has no lines; an empty text has one empty line; rows that repeat both id and text are one
document; null ids come first in the order and are kept in the result; an empty table gives none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakelayer.llm.common import col, stored

COARSE, FINE = 2, 16


def _lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = col(text_col).cast("string")
    return (df.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
            .select("doc_id", "th", F.posexplode(F.split("text", "\n", -1)).alias("no", "line")))


def _hashes(*parts: Column) -> tuple[Column, Column]:
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def _left(s: Column, n: Column) -> Column:
    return F.substr(s, F.lit(1), n)


def _from(s: Column, zero_based: Column) -> Column:
    return F.substr(s, zero_based + 1)


def _without_block(line: Column, length: Column, shorter: Column, j: Column, m: int) -> Column:
    """Hash of the line without its block j of m; blocks are laid out on the shorter line of a pair (``shorter``)."""
    b = F.floor(shorter * j / m).cast("int")
    e = F.floor(shorter * (j + 1) / m).cast("int")
    return F.xxhash64(shorter, j, _left(line, b), _from(line, length - (shorter - e)))


def _block_keys(line: Column, m: int) -> Column:
    """struct(key, d, j) of a line as the shorter or equal one (d = 0) and as the longer one (d = 1) of a pair."""
    n, blocks = F.length(line), F.sequence(F.lit(0), F.lit(m - 1))

    def side(d: int) -> Column:
        return F.transform(blocks, lambda j: F.struct(_without_block(line, n, n - d, j, m).alias("key"),
                                                      F.lit(d).alias("d"), j.alias("j")))

    return F.concat(side(0), side(1))


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not alone."""
    many = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    return rows.join(many, key, "left_semi")


def _variants(lines: DataFrame) -> DataFrame:
    """Deletion variants of (line, d, j): kind 's' without one position, or 'd' the line itself (d = 0) and the line one
    character shorter (d = 1)."""
    line, n = F.col("line"), F.length("line")
    short = n - F.col("d")
    b = F.floor(short * F.col("j") / FINE).cast("int")
    e = F.floor(short * (F.col("j") + 1) / FINE).cast("int")

    def cut(i: Column) -> Column:
        gone = _left(line, i), _from(line, i + 1)
        k1, k2 = _hashes(F.when(F.col("d") == 0, i).otherwise(F.lit(-1)), F.concat(*gone))
        return F.struct(k1.alias("k1"), k2.alias("k2"))

    last = F.when(F.col("d") == 0, e - 1).otherwise(e)
    at = F.when(b <= last, F.sequence(b, last)).otherwise(F.array().cast("array<int>"))
    w1, w2 = _hashes(F.lit(-1), line)
    own = F.when(F.col("d") == 0, F.array(F.struct(w1.alias("k1"), w2.alias("k2"))))
    cuts = (lines.select("ord", "d", F.explode(F.transform(at, cut)).alias("v"))
            .select("ord", F.when(F.col("d") == 0, "s").otherwise("y").alias("kind"), "v.k1", "v.k2"))
    whole = lines.select("ord", F.explode(own).alias("v")).select("ord", F.lit("x").alias("kind"), "v.k1", "v.k2")
    return cuts.union(whole).distinct()


def near_lines(first: DataFrame, lines: DataFrame, near_length: int) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line within one edit. ``first``: h1, h2, ord, keys."""
    coarse = _shared(first.where("keys is not null").select("h1", "h2", "ord", F.explode("keys").alias("key")), "key")
    places = coarse.select("h1", "h2", "ord").distinct()
    of = lines.where(F.length("line") >= near_length).select("h1", "h2", F.struct("doc_id", "th", "no").alias("ord"),
                                                             "line")
    texts = stored(of.join(places.select("h1", "h2", F.col("ord").alias("o")), ["h1", "h2"])
                   .where(F.col("o").eqNullSafe(F.col("ord"))).drop("o").dropDuplicates(["h1", "h2"]), "near-lines")
    fine = _shared(texts.select("ord", "line", F.explode(_block_keys(F.col("line"), FINE)).alias("b"))
                   .select("ord", "line", "b.key", "b.d", "b.j"), "key")
    rows = stored(_variants(fine.select("ord", "line", "d", "j")), "line-variants")
    low = rows.groupBy("k1", "k2").agg(*[F.min(F.when(F.col("kind") == k, F.col("ord"))).alias(f"first_{k}")
                                         for k in ("s", "x", "y")])
    partner = (F.when(F.col("kind") == "s", F.col("first_s")).when(F.col("kind") == "x", F.col("first_y"))
               .otherwise(F.col("first_x")))
    pairs = (rows.join(low, ["k1", "k2"]).select("ord", partner.alias("earlier"))
             .where(F.col("earlier").isNotNull() & (F.col("earlier") < F.col("ord"))).distinct())
    a = texts.select("h1", "h2", F.to_json("ord", {"ignoreNullFields": "false"}).alias("p"), F.col("line").alias("line"))
    b = texts.select(F.to_json("ord", {"ignoreNullFields": "false"}).alias("q"), F.col("line").alias("other"))
    keyed = pairs.select(F.to_json("ord", {"ignoreNullFields": "false"}).alias("p"),
                         F.to_json("earlier", {"ignoreNullFields": "false"}).alias("q"))
    return (keyed.join(a, "p").join(b, "q").where(F.levenshtein("line", "other", 1).between(0, 1))
            .select("h1", "h2").distinct())


def duplicate_lines(df: DataFrame, near_length: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, th (hash of its text), n_lines, n_removed, n_near (removed without an equal earlier
    line) and the removed line numbers in order."""
    h1, h2 = _hashes(F.col("line"))
    lines = _lines(df, id_col, text_col).withColumns({"h1": h1, "h2": h2})
    keys = F.when(F.length("line") >= near_length, F.transform(_block_keys(F.col("line"), COARSE), lambda b: b["key"]))
    first = stored(lines.where("line != ''").select("h1", "h2", F.struct("doc_id", "th", "no").alias("ord"),
                                                    keys.alias("keys"))
                   .groupBy("h1", "h2").agg(F.min("ord").alias("ord"), F.first("keys").alias("keys")), "first-lines")
    near = stored(near_lines(first, lines, near_length), "near-keys").withColumn("near", F.lit(True))
    verdict = first.select("h1", "h2", "ord").join(near, ["h1", "h2"], "left")
    own = F.struct("doc_id", "th", "no")
    judged = (lines.select("doc_id", "th", "no", "h1", "h2").join(verdict, ["h1", "h2"], "left")
              .select("doc_id", "th", "no",
                      (F.col("ord").isNotNull() & ~F.col("ord").eqNullSafe(own)).alias("again"),
                      F.coalesce("near", F.lit(False)).alias("near")))
    gone = F.col("again") | F.col("near")
    per_doc = (judged.groupBy("doc_id", "th")
               .agg(F.countDistinct("no").alias("n_lines"),
                    F.sort_array(F.collect_set(F.when(gone, F.col("no")))).alias("removed"),
                    F.size(F.collect_set(F.when(F.col("near") & ~F.col("again"), F.col("no")))).cast("long")
                    .alias("n_near")))
    empty = (df.where(col(text_col).isNull()).select(col(id_col).cast("long").alias("doc_id"),
                                                     F.xxhash64(col(text_col).cast("string")).alias("th")).distinct()
             .select("doc_id", "th", F.lit(0).cast("long").alias("n_lines"), F.array().cast("array<int>").alias("removed"),
                     F.lit(0).cast("long").alias("n_near")))
    out = reduce(DataFrame.unionByName, [per_doc, empty])
    return out.select("doc_id", "th", "n_lines", F.size("removed").cast("long").alias("n_removed"), "n_near", "removed")


def without_lines(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with its texts cleared of the removed lines."""
    text = col(text_col).cast("string")
    gone = found.select(F.col("doc_id").alias("_fid"), F.col("th").alias("_fth"), F.col("removed").alias("_gone"))
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    return (df.join(gone, (F.xxhash64(text) == F.col("_fth")) & col(id_col).cast("long").eqNullSafe(F.col("_fid")), "left")
            .select(*[(F.when(F.size("_gone") > 0, kept).otherwise(text) if c == text_col else col(c)).alias(c)
                      for c in df.columns]))


def line_dedup_query(df: DataFrame, near_length: int = 1) -> DataFrame:
    return duplicate_lines(df, near_length).select(
        "doc_id", "n_lines", "n_removed", "n_near",
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))


ORACLE = r"""
WITH l AS (
  SELECT d.doc_id, u.no, u.line FROM documents d,
  LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS line,
                  unnest(range(len(string_split(d.text, chr(10))))) AS no) u),
f AS (SELECT line, min(struct_pack(d := doc_id, n := no)) AS ord, length(line) AS n FROM l WHERE line <> '' GROUP BY line),
k AS (
  SELECT line, ord, n, n AS s, 0 AS j, substr(line, n // 2 + 1) AS key FROM f
  UNION ALL SELECT line, ord, n, n, 1, substr(line, 1, n // 2) FROM f
  UNION ALL SELECT line, ord, n, n - 1, 0, substr(line, (n - 1) // 2 + 2) FROM f
  UNION ALL SELECT line, ord, n, n - 1, 1, substr(line, 1, (n - 1) // 2) FROM f),
p AS (
  SELECT DISTINCT a.line, b.line AS other, a.n AS n, b.n AS m FROM k a JOIN k b
  ON a.s = b.s AND a.j = b.j AND a.key = b.key AND b.ord < a.ord),
near AS (
  SELECT DISTINCT line FROM p WHERE
  (n = m AND len(list_filter(range(1, n + 1), lambda i: substr(line, i, 1) <> substr(other, i, 1))) = 1)
  OR (n = m + 1 AND len(list_filter(range(1, n + 1), lambda i: substr(line, 1, i - 1) || substr(line, i + 1) = other)) > 0)
  OR (n + 1 = m AND len(list_filter(range(1, m + 1), lambda i: substr(other, 1, i - 1) || substr(other, i + 1) = line)) > 0)),
t AS (
  SELECT l.doc_id, l.no, f.ord IS NOT NULL AND f.ord <> struct_pack(d := l.doc_id, n := l.no) AS again,
         near.line IS NOT NULL AS near
  FROM l LEFT JOIN f ON l.line = f.line LEFT JOIN near ON l.line = near.line)
SELECT d.doc_id, count(t.no) AS n_lines, count(t.no) FILTER (again OR near) AS n_removed,
       count(t.no) FILTER (near AND NOT again) AS n_near,
       coalesce(string_agg(t.no::VARCHAR, ',' ORDER BY t.no) FILTER (again OR near), '') AS removed_lines
FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id GROUP BY d.doc_id
"""
