"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``. Whoever runs the stages writes each result and reads it again; ``run`` does so in the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import decontaminate, jaccard_join, packing, personal, quality_rules
from tarmac.llm.common import materialise, table, tokenizer_file

# Near copies share so many of their five-word shingles, in percent.
SHINGLE, PERCENT = 5, 80
CAPACITY = 2048


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep.

    A null or empty text fails the base rules. Repeated rows are judged one by one and alike, rows without
    an id by the same rules. Without labels the base rules alone decide. Texts are read whole; other
    columns pass unchanged. An empty table gives an empty one.
    """
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Of repeated rows of one id one stays; rows without an id are passed on as they are. A null or empty
    text is like no other and stays. Texts are compared whole; an empty table gives an empty one.
    """
    classes = jaccard_join.similar_classes(docs, SHINGLE, PERCENT)
    first = classes.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)
    return kept.union(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts hold none. Repeated rows are judged alike; nothing is looked at but the text,
    and of any length the whole of it. Without documents or items nothing goes.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by its kind.

    Null texts stay null and empty ones empty; every row, also a repeated one, is redacted by itself.
    Other columns pass unchanged, ``n_chars`` too. An empty table gives an empty one.
    """
    return personal.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences.

    A null or empty text is its end id alone. Repeated rows, and rows without an id, are packed one by
    one; ties in length are ordered by id and piece. An empty table gives an empty one.
    """
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"), CAPACITY)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

# Learned rules, fingerprints and tokenizers have no SQL; tests/llm holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
