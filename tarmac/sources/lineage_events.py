"""Lineage event documents: nested JSON, one per state of a run."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.variants import Path

# Field names of the document format.
SCHEDULER_FACET = "airflow"

_JOB = "job STRUCT<name: STRING, namespace: STRING>"
_RUN = "run STRUCT<runId: STRING>"
_INPUT_FIELD = "STRUCT<field: STRING, name: STRING, namespace: STRING>"
_DATASET = (
    "STRUCT<namespace: STRING, name: STRING, facets: STRUCT<"
    "schema: STRUCT<fields: ARRAY<STRUCT<name: STRING, type: STRING>>>, "
    # keyed by column name, so a map: inference would make one struct field per column
    f"columnLineage: STRUCT<fields: MAP<STRING, STRUCT<inputFields: ARRAY<{_INPUT_FIELD}>>>>>>"
)
_SCHEDULER = (
    "STRUCT<taskUuid: STRING, "
    "dagRun: STRUCT<run_id: STRING, run_after: STRING, start_date: STRING, logical_date: STRING, "
    "data_interval_start: STRING, data_interval_end: STRING>, "
    "taskInstance: STRUCT<log_url: STRING, try_number: INT>>"
)

EVENT_DDL = (
    "eventTime STRING, eventType STRING, producer STRING, schemaURL STRING, "
    "job STRUCT<namespace: STRING, name: STRING, facets: STRUCT<"
    "documentation: STRUCT<description: STRING>, "
    "jobType: STRUCT<integration: STRING, jobType: STRING, processingType: STRING>, "
    "ownership: STRUCT<owners: ARRAY<STRUCT<name: STRING>>>, "
    "sql: STRUCT<query: STRING>, "
    "tags: STRUCT<tags: ARRAY<STRUCT<key: STRING, source: STRING, value: STRING>>>>>, "
    "run STRUCT<runId: STRING, facets: STRUCT<"
    "nominalTime: STRUCT<nominalStartTime: STRING, nominalEndTime: STRING>, "
    f"parent: STRUCT<{_JOB}, {_RUN}, root: STRUCT<{_JOB}, {_RUN}>>, "
    "processing_engine: STRUCT<name: STRING, version: STRING>, "
    f"{SCHEDULER_FACET}: {_SCHEDULER}>>, "
    f"inputs ARRAY<{_DATASET}>, outputs ARRAY<{_DATASET}>"
)


def event_schema() -> T.StructType:
    return T.StructType.fromDDL(EVENT_DDL)


def read_events(spark: SparkSession, path: str, *, document_per_file: bool = True) -> DataFrame:
    """Read the declared fields of event documents. ``document_per_file=False`` reads one document per line, which splits.

    A document that is not JSON of this schema ends the read. Fields that are not declared are dropped; to write documents
    back whole, see ``read_documents``.
    """
    reader = spark.read.schema(event_schema()).option("multiLine", document_per_file).option("mode", "FAILFAST")
    return reader.json(path)


def read_documents(spark: SparkSession, path: str, *, document_per_file: bool = True) -> DataFrame:
    """(document): whole documents as variants, with every field. Lines of white space are skipped.

    Text that is not JSON, or an object with one name twice, ends the read. Numbers keep their value, not their spelling.
    """
    lines = spark.read.text(path, wholetext=document_per_file)
    # the search ends at the first character that is no white space; a replacement would go through all of a document
    return lines.filter(F.col("value").rlike(r"[^ \r\n\t]")).select(F.parse_json("value").alias("document"))


def _with_texts(kind: T.DataType, texts: Collection[Path], path: Path = ()) -> T.DataType:
    """The type with those text fields of its structs only that lie at one of the paths."""
    if isinstance(kind, T.StructType):
        below = [(f, (*path, f.name)) for f in kind.fields]
        fields = [(f.name, _with_texts(f.dataType, texts, at)) for f, at in below if f.dataType != T.StringType() or at in texts]
        return T.StructType([T.StructField(name, inner) for name, inner in fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_with_texts(kind.elementType, texts, (*path, "[]")))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _with_texts(kind.valueType, texts, (*path, "{}")))
    return kind


def declared_fields(document: Column, texts: Collection[Path] | None = None) -> Column:
    """The declared fields of a document as a struct; what is missing is NULL. A value of another type ends the job.

    With ``texts``, the struct holds of all text fields only those at these paths. Any value can be read as a text, so the
    same documents end the job.
    """
    kind = event_schema() if texts is None else _with_texts(event_schema(), texts)
    return F.variant_get(document, "$", kind.simpleString())
