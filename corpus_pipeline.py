"""A corpus pipeline over the table documents: from raw texts to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns all it keeps; run() writes each result and reads it
again. The stages, and what they decide:

1. quality: scores learnt from all labels; documents rejected at QUALITY go.
2. toxicity: scores learnt from all labels; documents that reach TOXIC go.
3. near duplicates: of each SimHash group the document with the smallest doc_id stays.
4. personal values: texts carry pseudonyms.
5. packing: the pieces of token sequences.

All but the last return the columns of documents. The models learn from the labelled documents of the
input table, so a stage behaves alike whatever its predecessor kept. Defined results: null texts count as
empty; rows without doc_id take part like others, but where a group has rows with an id, one of those
stays. Of rows that agree in doc_id and fingerprint one stays. An empty table gives no rows. Extra columns
are carried through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import packing, pii, quality, simhash, toxicity
from faultline.llm.common import materialise, table
from faultline.llm.queries import PSEUDONYM_KEY, tokenizer_file

#: A document stays if its quality is at least this,
QUALITY = 0.7
#: and its toxicity below this.
TOXIC = 0.5
SHINGLE_WORDS, RADIUS = 4, 4
WIDTH = 1024

#: A name that no column of the input has.
_SCORE = "__score"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", F.lit(True))
    return quality.score(docs, model, _SCORE).where(F.col(_SCORE) >= F.lit(QUALITY)).drop(_SCORE)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", F.lit(True))
    return toxicity.score(docs, model, _SCORE).where(F.col(_SCORE) < F.lit(TOXIC)).drop(_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, SHINGLE_WORDS, RADIUS)


def replace_personal_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = pii.pseudonymise(docs, PSEUDONYM_KEY)
    # some formats have values of different length
    return made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else made


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), WIDTH)


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_values", replace_personal_values),
    ("packing", pack),
]

#: The models, SimHash and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
