"""Corpus pipeline: from raw documents to packed training sequences.

Five stages, each written to the shared folder and read again as the next one's
input. All but the last return the columns of ``documents``:

* quality: scores every document and drops those below the threshold;
* language: drops documents without a known language: no letters, or a prediction that loses
  a decision so clearly that its score is below ``LEAST_SURE``;
* dedup: keeps one document of each group of near-duplicates (five-word shingles);
* mix: repeats and drops documents so that sources meet their target weights;
* pack: token pieces in sequences of at most 2048 tokens.

Every stage takes nulls in any column, empty and very long texts, repeated rows and ids, and an
empty table as its operator's module states: null and empty texts are scored by the
quality stage like others and dropped by the language stage as ``und``, which also
drops texts without a letter; copies are near-duplicates, and of repeated rows one
stays; ties are broken by ids and hashes, so reruns agree. Extra columns are
carried along unread, whatever their names.

SQL cannot express the classifiers and the tokeniser, so there is no SQL twin;
the tests hold each stage against a brute-force version on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import language, minhash_dedup, mix_sources, pack, quality
from keelson.llm.common import read, stash
from keelson.llm.queries import tokenizer_path

# A score is the product of two sigmoids, of the family's and the language's margin: a text that wins
# both has more than a quarter, however narrowly, so none of those is dropped.
LEAST_SURE = 0.25


def _whole(docs: DataFrame) -> DataFrame:
    """``doc_id, text, lang`` and all columns of a document as one, so that no name can clash."""
    return docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality.score(_whole(docs), read(spark, sf_dir, "labels"), ["row"])
    return scored.filter(F.col("__score") >= quality.THRESHOLD).select("row.*")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language.predict(_whole(docs), ["row"], language.fit(docs))
    sure = (F.col("__lang") != language.UNKNOWN) & (F.col("__score") >= LEAST_SURE)
    return found.filter(sure).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.drop_duplicates(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack.pack(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("language", keep_languages),
    ("dedup", keep_one_of_each),
    ("mix", mix_to_weights),
    ("pack", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
