"""A training corpus from ``documents``: every stage works on all that the one
before it kept, and is written to the shared folder before the next reads it.

1. language: rows whose language the fused evidence does not settle go;
2. near copies: one document of each SimHash component stays (fingerprints of
   three-word shingles, linked at two or fewer bits);
3. repeated strings: every byte that a repeated string of REPEAT bytes covers
   goes, which is less than any passage of fifty words of prose; a text that
   loses everything stays as an empty one;
4. mix: sources are brought to their target words; a document that the mix
   uses twice is two rows from here on;
5. packing: documents become pieces of token sequences.

ORACLE_SQL is None: neither hashes, text models nor tokenisation can be said in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import langid, mixing, packing, simhash, suffix_dedup
from tessera.llm.common import persisted, read_table


#: Bytes of the shortest repeated string that is removed.
REPEAT = 200


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted_documents(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=3, distance=2)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(docs, length=REPEAT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identified), ("simhash_near_dedup", without_near_copies), ("suffix_array_dedup", without_repeats),
    ("mix_sources", mixed), ("pack", packed)]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = persisted(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
