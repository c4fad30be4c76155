"""The corpus pipeline: documents to token files in five stages, each written as Parquet and read again."""

from newszones.llm.decontaminate import drop_contaminated
from newszones.llm.grades import keep_good
from newszones.llm.jaccard import keep_one
from newszones.llm.mixing import mix_documents
from newszones.llm.token_files import default_tokenizer, encode_and_read
from newszones.sources.storage import work_path, write_and_read

#: SQL cannot express the trained classifier, the similarity join or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def quality(spark, docs, sf_dir):
    """Documents that the classifier selects."""
    return keep_good(spark, docs, sf_dir)


def near_duplicates(spark, docs, sf_dir):
    """One document of each class of near duplicates."""
    return keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold too little of the benchmark to count."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark, docs, sf_dir):
    """Documents as often as the mix takes them."""
    return mix_documents(docs)


def token_files(spark, docs, sf_dir):
    """Where each document's ids lie in the token files, read back from them."""
    return encode_and_read(docs, default_tokenizer())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]


def run(spark, sf_dir):
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_and_read(stage(spark, docs, sf_dir), work_path(spark, name))
    return docs
