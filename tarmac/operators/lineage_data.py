"""Lineage events seen as data flow between datasets and columns.

Everything that concerns one document is computed inside its row with array and map functions; only
the final counting shuffles, after combining equal rows on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# (address, database) -> common name of the same database under all its addresses
Aliases = Mapping[tuple[str, str], str]

# Column type names used in the documents and their Spark types.
FACET_TYPES = {
    "int4": "int",
    "varchar": "string",
    "bpchar": "string",
    "text": "string",
    "numeric": "decimal",
    "timestamp": "timestamp_ntz",
    "bool": "boolean",
    "date": "date",
    "_text": "array<string>",
}


def spark_type(facet_type: Column) -> Column:
    """Spark type name for a type name of a document; unknown names stay as they are."""
    known = F.create_map(*[F.lit(text) for pair in FACET_TYPES.items() for text in pair])
    return F.coalesce(F.try_element_at(known, facet_type), facet_type)


def moved_address(namespace: Column, endpoints: Mapping[str, str]) -> Column:
    """The address, or the one that replaces it (old -> new)."""
    if not endpoints:
        return namespace
    known = F.create_map(*[F.lit(text) for pair in endpoints.items() for text in pair])
    return F.coalesce(F.try_element_at(known, namespace), namespace)


def dataset_id(namespace: Column, name: Column, aliases: Aliases, endpoints: Mapping[str, str] | None = None) -> Column:
    """Address and name as one text; aliased databases get their common name, replaced addresses (old -> new) the new one.

    Only a listed (address, database) pair is replaced. Tables that merely share a name stay apart.
    """
    namespace = moved_address(namespace, endpoints or {})
    plain = F.concat(namespace, F.lit("/"), name)
    if not aliases:
        return plain
    known = F.create_map(
        *[F.lit(text) for (ns, db), common in aliases.items() for text in (f"{ns}/{db}", common)]
    )
    database = F.substring_index(name, ".", 1)
    rest = F.substring(name, F.length(database) + 2, F.length(name))
    common = F.try_element_at(known, F.concat(namespace, F.lit("/"), database))
    return F.coalesce(F.concat(common, F.lit("/"), rest), plain)


def _no_texts() -> Column:
    return F.array().cast("array<string>")


def dataset_edges(events: DataFrame, aliases: Aliases) -> DataFrame:
    """input dataset -> job and job -> output dataset, with the number of events that report each edge.

    Inputs are not paired with outputs: a job is a node of its own. Only addresses and names are read.
    """

    def ends(side: str, kind: str) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            F.coalesce(F.col(f"{side}.namespace"), _no_texts()).alias("namespace"),
            F.coalesce(F.col(f"{side}.name"), _no_texts()).alias("name"),
        )

    job = F.concat(F.lit("job:"), F.col("job.namespace"), F.lit("/"), F.col("job.name"))
    sides = events.select(job.alias("job_id"), F.inline(F.array(ends("inputs", "read"), ends("outputs", "write"))))
    # an event counts once for a dataset, however often it names it
    named = sides.select("job_id", "kind", F.inline(F.array_distinct(F.arrays_zip("namespace", "name"))))
    dataset, is_read = dataset_id(F.col("namespace"), F.col("name"), aliases), F.col("kind") == "read"
    return (
        named.select("job_id", "kind", dataset.alias("dataset"))
        .groupBy(
            F.when(is_read, F.col("dataset")).otherwise(F.col("job_id")).alias("src"),
            F.when(is_read, F.col("job_id")).otherwise(F.col("dataset")).alias("dst"),
            "kind",
        )
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def lineage_gap(edges: DataFrame) -> DataFrame:
    """Datasets that some job reads but none writes, with the number of reading events."""
    is_read = F.col("kind") == "read"
    return (
        edges.groupBy(F.when(is_read, F.col("src")).otherwise(F.col("dst")).alias("dataset"))
        .agg(
            F.sum(F.when(is_read, F.col("n_events"))).alias("n_reads"),
            F.count(F.when(~is_read, 1)).alias("writers"),
        )
        .filter("writers = 0")
        .drop("writers")
    )


def _outputs(events: DataFrame, aliases: Aliases, endpoints: Mapping[str, str] | None = None) -> DataFrame:
    """One row per (event, output) that has column lineage."""
    declared = F.zip_with("inputs.namespace", "inputs.name", lambda ns, name: F.concat(ns, F.lit("/"), name))
    return (
        events.select(F.coalesce(declared, _no_texts()).alias("declared"), F.explode("outputs").alias("o"))
        .select(
            "declared",
            dataset_id(F.col("o.namespace"), F.col("o.name"), aliases, endpoints).alias("dataset"),
            F.col("o.facets.columnLineage.fields").alias("fields"),
            F.col("o.facets.schema.fields.name").alias("schema_columns"),
        )
        .filter(F.col("fields").isNotNull())
    )


def column_edges(events: DataFrame, aliases: Aliases, endpoints: Mapping[str, str] | None = None) -> DataFrame:
    """source column -> output column as written in the events, with the number of events.

    ``endpoints`` replaces addresses (old -> new), as rewriting the documents with ``lineage_runs.align_endpoints`` would.
    """
    entries = _outputs(events, aliases, endpoints).select("dataset", F.explode("fields").alias("column_name", "entry"))
    return (
        entries.select("dataset", "column_name", F.explode(F.array_distinct("entry.inputFields")).alias("f"))
        .select(
            "dataset",
            "column_name",
            dataset_id(F.col("f.namespace"), F.col("f.name"), aliases, endpoints).alias("src_dataset"),
            F.col("f.field").alias("src_column"),
        )
        .groupBy("dataset", "column_name", "src_dataset", "src_column")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def collapse_intermediates(events: DataFrame, aliases: Aliases) -> DataFrame:
    """Column edges with helper datasets replaced by what lies behind them.

    A source that is not among the event's inputs is a helper (a temporary table, a named subquery). Entries of the
    lineage map whose key is no column of the output describe the helpers' columns; they are followed, through
    any number of helpers, to declared inputs (``collapsed``) or to sources without such an entry (``unresolved``). An
    entry is followed once for each output column. A column whose helpers lead only to each other keeps its
    own sources as ``unresolved``. Where the output has no schema nothing is followed.
    """

    edge_type = "array<struct<namespace: string, name: string, src_column: string, status: string>>"

    def marked(_: Column, entry: Column) -> Column:
        """The sources of an entry, each with whether it is an input and whether it is followed."""

        def source(f: Column) -> Column:
            is_input = F.coalesce(F.array_contains("declared", F.concat(f["namespace"], F.lit("/"), f["name"])), F.lit(False))
            is_open = F.coalesce(~is_input & F.array_contains("helper_keys", f["field"]), F.lit(False))
            return F.struct(f["namespace"].alias("namespace"), f["name"].alias("name"), f["field"].alias("field"), is_input.alias("is_input"), is_open.alias("is_open"))

        return F.transform(F.array_distinct(entry["inputFields"]), source)

    def ends(sources: Column, reached: Column) -> Column:
        """Edges from the sources that are not followed."""
        closed = F.filter(sources, lambda f: ~f["is_open"])
        status = lambda f: F.when(f["is_input"], reached).otherwise(F.lit("unresolved"))
        return F.transform(
            closed,
            lambda f: F.struct(f["namespace"].alias("namespace"), f["name"].alias("name"), f["field"].alias("src_column"), status(f).alias("status")),
        )

    def follow(state: Column, step: Column) -> Column:
        keys = F.array_distinct(F.transform(F.filter(state["sources"], lambda f: f["is_open"]), lambda f: f["field"]))
        unseen = F.array_except(keys, state["seen"])
        behind = F.transform(unseen, lambda key: F.try_element_at(F.col("marked"), key))
        followed = F.struct(
            F.array_distinct(F.flatten(behind)).alias("sources"),
            F.concat(state["seen"], unseen).alias("seen"),
            F.array_union(state["found"], ends(state["sources"], F.when(step == 1, F.lit("direct")).otherwise(F.lit("collapsed")))).alias("found"),
        )
        # nothing left to follow: the remaining steps cost nothing
        return F.when(F.size(state["sources"]) == 0, state).otherwise(followed)

    # an entry is followed once for a column, so one step more than there are helper entries reaches every end
    steps = F.sequence(F.lit(1), F.size("helper_keys") + 1)
    start = F.struct(F.col("sources").alias("sources"), _no_texts().alias("seen"), F.array().cast(edge_type).alias("found"))
    walked = F.aggregate(steps, start, follow, lambda state: state["found"])
    is_open = F.exists("sources", lambda f: f["is_open"])
    unknown = ends(F.transform("sources", lambda f: f.withField("is_open", F.lit(False)).withField("is_input", F.lit(False))), F.lit(""))
    helpers = F.map_filter(
        "fields",
        lambda key, entry: F.coalesce(~F.array_contains(F.col("schema_columns"), key) & (F.size(entry["inputFields"]) > 0), F.lit(False)),
    )
    return (
        _outputs(events, aliases)
        .select("dataset", "declared", "fields", F.map_keys(helpers).alias("helper_keys"))
        .select("dataset", "helper_keys", F.transform_values("fields", marked).alias("marked"))
        .select("dataset", "helper_keys", "marked", F.explode("marked").alias("column_name", "sources"))
        .withColumn("found", F.when(is_open, walked).otherwise(ends(F.col("sources"), F.lit("direct"))))
        .select("dataset", "column_name", F.inline(F.when(F.size("found") > 0, F.col("found")).otherwise(unknown)))
        .groupBy(
            "dataset",
            "column_name",
            dataset_id(F.col("namespace"), F.col("name"), aliases).alias("src_dataset"),
            "src_column",
            "status",
        )
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def lineage_schema_check(events: DataFrame, aliases: Aliases) -> DataFrame:
    """Output columns named in the lineage but not in the schema, and the other way round."""

    def problems(columns: Column, text: str) -> Column:
        return F.transform(columns, lambda c: F.struct(c.alias("column_name"), F.lit(text).alias("problem")))

    in_lineage, in_schema = F.map_keys("fields"), F.col("schema_columns")
    found = F.concat(
        problems(F.array_except(in_lineage, in_schema), "not in schema"),
        problems(F.array_except(in_schema, in_lineage), "no lineage"),
    )
    return (
        _outputs(events, aliases)
        .filter(F.col("schema_columns").isNotNull())
        .select("dataset", F.inline(found))
        .groupBy("dataset", "column_name", "problem")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def schema_columns(events: DataFrame, aliases: Aliases) -> DataFrame:
    """One row per (event, dataset, column): the role of the dataset in the event and the column type."""

    def side(name: str, role: str) -> Column:
        return F.struct(
            F.lit(role).alias("role"),
            F.arrays_zip(
                F.col(f"{name}.namespace").alias("namespace"),
                F.col(f"{name}.name").alias("name"),
                F.col(f"{name}.facets.schema.fields").alias("fields"),
            ).alias("datasets"),
        )

    sides = events.select(F.inline(F.array(side("inputs", "reader"), side("outputs", "writer"))))
    return (
        sides.select("role", F.inline("datasets"))
        .select("role", dataset_id(F.col("namespace"), F.col("name"), aliases).alias("dataset"), F.inline("fields"))
        .select("role", "dataset", F.col("name").alias("column_name"), spark_type(F.col("type")).alias("type"))
    )


def schema_drift(columns: DataFrame) -> DataFrame:
    """Columns on which readers and writers of a dataset disagree.

    ``columns`` holds (role, dataset, column_name, type) with the roles ``reader`` and ``writer``; only
    datasets seen in both roles are compared. This is a full outer match on the column name, done as
    one grouping. A side that reports several types for a column shows as ``several types``. Equal rows are dropped first:
    least and greatest texts are found by sorting, which would take in the columns of all events. (The rows are laid
    out by dataset in between, else the optimizer takes the two groupings for one.)
    """

    def types(role: str) -> list[Column]:
        seen = F.when(F.col("role") == role, F.col("type"))
        return [F.min(seen).alias(f"{role}_type"), F.max(seen).alias(f"{role}_last")]

    different = columns.select("dataset", "column_name", "role", "type").distinct().repartition("dataset")
    per_column = different.groupBy("dataset", "column_name").agg(*types("reader"), *types("writer"))
    same_dataset = Window.partitionBy("dataset")
    both_roles = F.max(F.col("reader_type").isNotNull()).over(same_dataset) & F.max(
        F.col("writer_type").isNotNull()
    ).over(same_dataset)
    reader, writer = F.col("reader_type"), F.col("writer_type")
    status = (
        F.when(reader.isNull(), F.lit("only writer"))
        .when(writer.isNull(), F.lit("only reader"))
        .when((reader != F.col("reader_last")) | (writer != F.col("writer_last")), F.lit("several types"))
        .when(reader != writer, F.lit("other type"))
    )
    return (
        per_column.withColumns({"both_roles": both_roles, "status": status})
        .filter(F.col("both_roles") & F.col("status").isNotNull())
        .select("dataset", "column_name", "reader_type", "writer_type", "status")
    )
