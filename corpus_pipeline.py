"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a frame that
is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidestrata.llm import decontaminate, hash_index, packing, simhash, toxicity
from tidestrata.llm.common import stored
from tidestrata.llm.queries import table, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half; without labelled toxic ones all stay.

    A null text scores like an empty one. Repeated rows score alike, so all of them stay or go.
    """
    return toxicity.without_toxic(docs, toxicity.learnt(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id.

    Texts are equal if they are after A-Z are lower-cased, null as empty. A null id counts least. Of rows
    repeated in id and text one stays.
    """
    return hash_index.without_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints are linked, the one with the smallest id.

    Fingerprints are of 3-word shingles and linked at 2 differing bits or fewer, as in ``op1_simhash``.
    Texts without words have fingerprint 0. A null id counts last; rows repeated in id and text stay
    together.
    """
    return simhash.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    A null text contains none. Rows are judged by their texts alone, so null and repeated ids do no harm.
    """
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in training sequences.

    A null text is empty and has its closing token alone. Repeated rows are packed as often as they come.
    """
    return packing.packed(packing.token_pieces(docs, vocabulary(), special=True))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: Learnt scores, fingerprints and token ids are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next.

    Columns beyond those of the data model go through the stages as they are, whatever their names. An empty
    table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
