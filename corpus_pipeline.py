"""A training corpus from ``documents``: language ID, exact dedup, SimHash near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs.
The first four return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakelayer.llm import decontaminate, exact_dedup, lang_id, packing, simhash
from lakelayer.llm.common import stored, table
from lakelayer.llm.queries import tokenizer_path
from lakelayer.session import configure

MIN_HIT_WORDS = 10       # one whole benchmark window
CARRIED = "corpus_pipeline_carried_columns"


def keeping_columns(docs: DataFrame, used: list[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage`` over the ``used`` columns alone, the others carried along in one struct: a column of the documents may
    have any name, also one that an operator gives to a result, and comes out as it went in."""
    used = [c for c in docs.columns if c in used]
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in used], F.lit(0).alias(CARRIED))
    kept = stage(docs.select(*used, others.alias(CARRIED)))
    return kept.select(*[F.col(c) if c in used else F.col(f"{CARRIED}.`{c}`").alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter (null and empty ones, too), by their text alone: neither the predicted language
    nor its score decides, and without a labelled row to learn from no other document goes. The model learns from this
    stage's input. Repeated rows stay; an empty table stays empty."""
    model = lang_id.fit(docs.select("doc_id", "text", "lang"), ~lang_id.held_out())

    def labelled(d: DataFrame) -> DataFrame:
        return lang_id.label(d, model, lang_out="_lang_pred", score_out="_lang_score", letter_out="_lang_letter").where("_lang_letter")
    return keeping_columns(docs, ["doc_id", "text"], labelled)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays (a null id only if all are null; of rows that repeat id and
    text, one). Null counts as the empty text. An empty table stays empty."""
    return keeping_columns(docs, ["doc_id", "text"], lambda d: exact_dedup.distinct_rows(d, keep="min"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the row with the smallest doc_id stays; texts without a word, null ones too, are linked
    to each other. Rows that repeat this id and text all stay. An empty table stays empty."""
    return keeping_columns(docs, ["doc_id", "text"], lambda d: simhash.one_per_group(d, words=3, bits=3))


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go, each row judged by its own text; null and empty texts hold none.
    Repeated rows share one fate. An empty table, or an empty benchmark, loses nothing."""
    def clean(d: DataFrame) -> DataFrame:
        return decontaminate.find_windows(d, table(spark, sf_dir, "benchmark"), window=MIN_HIT_WORDS).where(F.size("hit_spans") == 0)
    return keeping_columns(docs, ["doc_id", "text"], clean)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens; a null text is empty (one token), repeated rows and ids are
    documents of their own, other columns are not read. An empty table gives no pieces."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=1, window=2048)


STAGES = [("language_id", language), ("exact_dedup", exact), ("simhash_near_dedup", near),
          ("decontamination", clean_of_benchmark), ("packing", packed)]

# language ID, SimHash and packing are no SQL: tests hold the pipeline against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
