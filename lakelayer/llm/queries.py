"""The driver queries of this subpackage: one per operator, over the whole intended table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakelayer.llm.common import table
from lakelayer.session import configure, scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def _warc_oracle() -> str:
    from lakelayer.llm.warc import ORACLE
    return ORACLE


def _line_oracle() -> str:
    from lakelayer.llm.line_dedup import ORACLE
    return ORACLE


@_query("op1_suffix_dedup")
def suffix_dedup(spark, sf_dir):
    """Bytes covered by 200-byte strings that occur elsewhere, over all documents."""
    from lakelayer.llm.suffix_dedup import repeated_passages
    return repeated_passages(table(spark, sf_dir, "documents"), length=200).drop("spans")


@_query("op2_language_id")
def language_id(spark, sf_dir):
    """Language of every document by a word-level CRF."""
    from lakelayer.llm.lang_id import language_query
    return language_query(table(spark, sf_dir, "documents"))


@_query("op3_warc_derivatives", _warc_oracle())
def warc(spark, sf_dir):
    """Metadata and conversion records of every page, with their links and digests."""
    from lakelayer.llm.warc import warc_query
    return warc_query(table(spark, sf_dir, "pages"))


@_query("op4_simhash_near_dedup")
def simhash(spark, sf_dir):
    """SimHash components: 3-word shingles, links at 3 or fewer differing bits."""
    from lakelayer.llm.simhash import near_duplicate_query
    return near_duplicate_query(table(spark, sf_dir, "documents"), words=3, bits=3)


@_query("op5_decontamination", r"""
WITH dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM iw WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, ns WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, win.n, item_id FROM grams JOIN win USING (n, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hits)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos ON dw.doc_id = pos.doc_id LEFT JOIN its ON dw.doc_id = its.doc_id
""")
def decontamination(spark, sf_dir):
    """Benchmark windows of 10 words in every document."""
    from lakelayer.llm.decontaminate import contamination
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


@_query("op6_token_files")
def token_files(spark, sf_dir):
    """Write the ids of all documents as Parquet lists, read them back and digest them."""
    from lakelayer.llm.token_files import read_tokens, token_digests, write_token_files
    path = scratch_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    return token_digests(read_tokens(spark, path))


@_query("op7_personal_data")
def personal_data(spark, sf_dir):
    """Personal data spans of every document."""
    from lakelayer.llm import pii
    docs = table(spark, sf_dir, "documents")
    return pii.personal_data(docs, pii.fit(docs))


@_query("op8_packing")
def packing(spark, sf_dir):
    """Sum-of-squares packing of all documents into windows of 2048 tokens."""
    from lakelayer.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=1, window=2048)


@_query("op9_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
""")
def exact_dedup(spark, sf_dir):
    """Equal texts by content sort; the largest doc_id stays."""
    from lakelayer.llm.exact_dedup import duplicate_groups
    return duplicate_groups(table(spark, sf_dir, "documents"), keep="max")


@_query("op10_line_dedup", _line_oracle())
def line_dedup(spark, sf_dir):
    """Lines with an equal or one-edit earlier line, per document, whatever their length."""
    from lakelayer.llm.line_dedup import line_dedup_query
    return line_dedup_query(table(spark, sf_dir, "documents"))


def _vector_code_oracle() -> str:
    from lakelayer.llm.vector_codes import oracle
    return oracle()


@_query("op13_vector_codes", _vector_code_oracle())
def vector_codes(spark, sf_dir):
    """Product codes of every usable vector, with codebooks learned in integers."""
    from lakelayer.llm.vector_codes import vector_codes_query
    return vector_codes_query(table(spark, sf_dir, "embeddings"))


def _hard_negative_oracle() -> str:
    from lakelayer.llm.hard_negatives import ORACLE
    return ORACLE


@_query("op11_hard_negatives", _hard_negative_oracle())
def hard_negatives(spark, sf_dir):
    """For every anchor and positive, the first rows of another label within the score window."""
    from lakelayer.llm.hard_negatives import hard_negative_query
    return hard_negative_query(table(spark, sf_dir, "embeddings"))


@_query("op12_license_scan")
def license_scan(spark, sf_dir):
    """Licence signatures in every document: base phrases, all labels, confidence."""
    from lakelayer.llm.licenses import license_query
    return license_query(table(spark, sf_dir, "documents"))
