"""Study metadata by instance path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflow.functions.webpath import with_web_path
from clinflow.operators.lookups import lookup_join, within_span
from clinflow.operators.outcomes import checked, error_entry
from clinflow.session import work_dir, written
from clinflow.sinks.study_store import STUDY_KEY, StudyStore

READ_STEP = "ReadStudyMetadata"


def path_counts(parsed: DataFrame) -> DataFrame:
    """Paths per study, ``_n``; those that name none have a row without a key."""
    return parsed.groupBy(*STUDY_KEY).agg(F.count(F.lit(1)).alias("_n"))


def notified_studies(counts: DataFrame) -> DataFrame:
    """One row per study that valid paths name, with the number of its notifications."""
    return counts.filter(F.col("study_id").isNotNull()).withColumnRenamed("_n", "n_notifications")


def resolve_paths(
    parsed: DataFrame, known: DataFrame, counts: DataFrame | None = None, **limits: int
) -> DataFrame:
    """Each notified path, and whether its study is known.

    Rejected rows keep the path as error resource. A path costs one row no matter how large its
    study is. With ``counts``, the written :func:`path_counts`, no path is read to find heavy studies.
    """
    keys = known.select(*STUDY_KEY, F.lit(True).alias("_known"))
    found = lookup_join(parsed, keys, STUDY_KEY, counts=counts, **limits)
    message = F.when(F.col("study_id").isNull(), F.lit("Invalid DICOM web path")).otherwise(
        F.concat(F.lit("no metadata for study "), F.col("study_id"))
    )
    entry = error_entry(message, READ_STEP, resource=F.coalesce("path", F.lit("")))
    return checked(found, F.col("_known"), entry).drop("_known")


def study_documents(
    instances: DataFrame | StudyStore, wanted: DataFrame, **limits: int
) -> DataFrame:
    """The JSON array of each wanted study the store knows, from its instances' ``metadata``.

    A study is one array, in order of ``instance_id``, read once however many of its instances were
    notified; the row says how many were. Of a ``StudyStore`` the buckets of the wanted studies are
    read. Of a table the span of the wanted keys reaches the reader, so one that is sorted by study
    is read between the first and the last of them. Heavy studies are not spread for the join: each
    one's instances meet in a task after it anyway, by the same shuffle.
    """
    limits = limits | {"hot_rows": None}
    if isinstance(instances, StudyStore):
        chosen = instances.of(wanted, **limits)
    else:
        span = within_span(instances, wanted, STUDY_KEY)
        chosen = lookup_join(span, wanted, STUDY_KEY, "inner", **limits)
    member = F.struct("instance_id", "metadata")
    listed = chosen.groupBy(*STUDY_KEY, "n_notifications").agg(
        F.sort_array(F.collect_list(member)).alias("_members")
    )
    texts = F.transform("_members", lambda m: m["metadata"])
    return listed.select(
        *STUDY_KEY,
        "n_notifications",
        F.size("_members").cast("long").alias("n_instances"),
        F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")).alias("study"),
    )


def read_studies(
    paths: DataFrame, instances: DataFrame | StudyStore, scratch: str | None = None, **limits: int
) -> tuple[DataFrame, DataFrame]:
    """S12 with its dead letter: the notified studies, and the paths with ``ok`` and ``error``.

    The keys of the notified studies, and then the studies found, are written to ``scratch`` first:
    both are used more than once, and the store is read once.
    """
    base = work_dir(paths.sparkSession, "studies") if scratch is None else scratch
    parsed = with_web_path(paths)
    counts = written(path_counts(parsed), f"{base}/wanted")
    wanted = notified_studies(counts)
    studies = written(study_documents(instances, wanted, **limits), f"{base}/studies")
    return studies, resolve_paths(parsed, studies, counts, **limits)
