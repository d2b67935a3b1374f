"""Documents to training sequences: what is toxic, foreign, repeated or of a benchmark goes.

Every stage takes all documents that the one before kept and returns them with the columns
that they came with; the last returns packed pieces. Rows are kept or dropped whole.

- toxicity: documents whose score is TOXIC_SCORE or more go. Learned from the labelled
  documents among those given; without labels of both kinds none go.
- language: documents without a letter, or null, go, also where no language can be learned.
- near_duplicates: of documents linked by a Jaccard similarity of 0.8 or more over shingles
  of five words the one with the smallest doc_id stays. Texts without words stay.
- decontamination: documents that hold a window of a benchmark item go.
- packing: as operator 4, at most 2048 ids.

Null texts, repeated rows, ties, empty tables and columns beyond those of documents are
treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.llm import decontamination, jaccard_join, language_id, packing, queries, sketch, toxicity
from gaugeflow.llm.tables import held_out, load, tuned


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, load(spark, sf_dir, "labels").where(~held_out()))
    return docs.where(toxicity.score("text", model) < queries.TOXIC_SCORE)


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs.where(~held_out()))
    if not model.languages:
        return docs.where(language_id.has_letter("text", model))
    return docs.where(language_id.identify("text", model)["lang_pred"] != language_id.UNKNOWN)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    joined = session.stage(jaccard_join.jaccard_join(docs, size=5, num=80, den=100), "joined")
    return sketch.without(docs, session.stage(jaccard_join.repeats(joined), "repeats"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(docs, load(spark, sf_dir, "benchmark"))
    named = found.where("contaminated").select("doc_id", "k", F.lit(False).alias("keep"))
    return sketch.without(docs, session.stage(named, "contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.tokenizer("word_bpe_49k.json"), capacity=2048)


STAGES = [
    ("toxicity", tuned(drop_toxic)),
    ("language", tuned(drop_unidentified)),
    ("near_duplicates", tuned(drop_near_duplicates)),
    ("decontamination", tuned(drop_contaminated)),
    ("packing", tuned(pack)),
]

#: Learned scores cannot be told in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = session.stage(stage(spark, docs, sf_dir), name)
    return docs
