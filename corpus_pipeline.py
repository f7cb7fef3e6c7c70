"""A training corpus from `documents`: language ID, near-dedup, mixing, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm import langid, mixing, neardup, pieces
from loam.llm.queries import PIECE_MODEL
from loam.llm.shared import new_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear stay, all their columns as they are."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return langid.identified(docs, docs.filter(rest != 2)).filter("accepted").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, similarity 0.8)."""
    return neardup.near_dedup(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mix(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with the ids of the text's pieces, in place of columns of these names."""
    found = pieces.encoded(docs, pieces.PieceModel.load(PIECE_MODEL))
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("ids", "n_tokens")]
    return found.select(*own, "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup), ("mixing to target weights", source_mix), ("SentencePiece encoding", piece_ids)]
#: SQL has no zstandard, XXH64 or Viterbi; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each one returns is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out, path = stage(spark, docs, sf_dir), new_path(spark, f"stage{k + 1}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
