"""Cleaning a corpus: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and reads it again for the next stage.

1. toxicity: documents that score as toxic go.
2. quality: documents that score as junk go.
3. near duplicates: of each SimHash component one document stays.
4. decontamination: documents with a benchmark passage go.
5. byte-level BPE: the tokens of what is left, decoded again as a check.

All but the last keep the columns of the documents, whatever they are. Null
texts count as empty ones in every stage. Extra columns are kept, and names that
clash with those of an operator do no harm. A row without an id is treated like
any other. Repeated rows are near duplicates of each other. From an empty table
nothing comes out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowline.llm import bpe, decontaminate, quality, simhash, toxicity
from flowline.llm.queries import byte_bpe_definition, token_digests
from flowline.llm.tables import table
from flowline.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels outside the held-out third and drops documents that score THRESHOLD or more."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the votes on all documents, without labels, and drops those that score as junk."""
    return quality.of_quality(docs, quality.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id stays, one row of it."""
    return simhash.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a passage of the benchmark is found."""
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what they decode to."""
    return token_digests(bpe.round_trip(docs, byte_bpe_definition()))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_junk),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte-level BPE", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


#: Lexicon, label model and tokenizer are beyond SQL; tests compare with plain versions of each stage instead.
ORACLE_SQL = None
