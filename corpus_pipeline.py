"""Raw documents to token ids, in stages that are each written as Parquet before the next begins."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvec.cluster import written
from docvec.llm import jaccard, language, mixing, pieces, secrets
from docvec.llm.kernels import set_aside, small_batches

# A text whose language is less certain than this is in none of the learned languages.
LEAST_SCORE = 0.2
VOCABULARY = "piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn the languages from the labelled documents; documents in none of them go, a missing label is filled in.

    A null or empty text, or one without a letter, is in no language and goes, as all do where no
    document has a label. Whole texts of any length are judged; rows that repeat are judged alike;
    all columns come back as they were, whatever their names. An empty table stays empty.
    """
    small_batches(spark)
    docs, given = set_aside(docs, "doc_id", "text", "lang")
    found = language.identify(docs, language.fit(docs))
    known = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return given(known.withColumn("lang", F.coalesce("lang", "lang_pred")))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id, of repeated rows one.

    A null or empty text is like no other and stays, as does a row without a doc_id whose text is its
    own. Shingles are of whole texts; all columns stay; an empty table stays empty.
    """
    small_batches(spark)
    return jaccard.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and n_chars is the new length.

    A null text stays null, with a null length, and an empty one stays empty; texts of any length are
    searched whole; repeated rows change alike; other columns stay; an empty table stays empty.
    """
    small_batches(spark)
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated until every source has its share of words.

    A text without words, null or empty, is kept once. A null source is a source of its own, the last
    one. Ties go by the text's hash; repeated rows are documents of their own; all columns stay; an
    empty table stays empty.
    """
    small_batches(spark)
    return mixing.repeat(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text: a null text has null ids and no tokens, an empty one none.

    Rows that repeat are encoded each; texts of any length whole; of the columns doc_id, source and
    lang stay; an empty table stays empty.
    """
    small_batches(spark)
    coded = pieces.encode(docs, public_tokenizers.path(VOCABULARY))
    return coded.select("doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_join),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding", sentencepiece),
]

# Learned languages and pieces have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
