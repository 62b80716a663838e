"""From raw documents to token files: each stage works on what the one before has kept."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from clinflow.llm import curriculum, decontaminate, host_rules, jaccard, token_files
from clinflow.llm.common import own_tables
from clinflow.llm.queries import vocabulary
from clinflow.session import table, work_dir, written
from clinflow.sinks.files import remove_listed

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Working tables that the result of this thread's last stage is read from.
_last: ContextVar[tuple[str, ...]] = ContextVar("tables of the last stage", default=())


def after_the_last(stage: Stage) -> Stage:
    """A stage's documents are the last one's result, written and read again, or as it came. Once a
    stage is called with documents that don't come from the last one's working tables, these are
    removed; else they are kept, as long as its own result is."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        old = _last.get()
        if old and any(name in file for file in docs.inputFiles() for name in map(folder_name, old)):
            kept = old
        else:
            remove_listed(spark, list(old))
            kept = ()
        with own_tables() as paths:
            result = stage(spark, docs, sf_dir)
        _last.set((*kept, *paths))
        return result

    return run_stage


def folder_name(path: str) -> str:
    """The last part of a working table's path, which no other has, however the path is written."""
    return f"/{path.rstrip('/').rsplit('/', 1)[-1]}/"


@after_the_last
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules and come from no rejected host."""
    return host_rules.kept_rows(docs)


@after_the_last
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return jaccard.representatives(docs, percent=90)


@after_the_last
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items, unchanged."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


@after_the_last
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, in the order of the training run."""
    return curriculum.training_order(curriculum.assign(docs))


@after_the_last
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left; a row per document in them."""
    return token_files.token_digests(docs, token_files.Encoding(vocabulary("byte_bpe_50k.json")))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: SQL has no tokenizer; the stages are tested against plain versions of them instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), work_dir(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
