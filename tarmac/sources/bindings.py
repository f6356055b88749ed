"""The source tables of the jobs, derived from a star schema of orders, customers, suppliers and events.

Every function reads whole tables from ``<folder>/<name>.parquet`` and maps their rows one to one.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.choose import first_match
from tarmac.functions.time import add_millis, iso_micros, iso_seconds, timestamp_lit
from tarmac.operators.lineage_data import FACET_TYPES
from tarmac.sources.lineage_events import SCHEDULER_FACET, event_schema

AS_OF = dt.date(2020, 6, 15)
RUN_TS = dt.datetime(2020, 6, 15, 12, 0, 0)
FIRST_LOAD_UNTIL = dt.datetime(1998, 7, 1)
EPOCH = dt.datetime(1995, 1, 1)

RATINGS = ("B737", "B757", "A320", "A321", "B777", "B787")
CREW_STATUSES = ("AVAILABLE", "ON_DUTY", "OFF_DUTY", "SICK", "GROUNDED")
CREW_ROLES = ("CAPTAIN", "FIRST_OFFICER", "FLIGHT_ATTENDANT")

ALIASES = {
    ("postgres://warehouse-a:5432", "defaultdb"): "warehouse",
    ("postgres://warehouse-b:5432", "postgres"): "warehouse",
}


# Declared types of the given tables, so that no file is opened to infer them.
STAR_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _pick(values: tuple[str, ...], position: Column) -> Column:
    texts = F.expr(f"array({', '.join(repr(v) for v in values)})")
    return F.element_at(texts, (position % len(values) + 1).cast("int"))


def flights(spark: SparkSession, folder: str) -> DataFrame:
    """One flight per order."""
    place = (
        star_table(spark, folder, "nation")
        .join(star_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    customer = (
        star_table(spark, folder, "customer")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_mktsegment", "n_name", "r_name")
    )
    orders = star_table(spark, folder, "orders")
    hours = F.make_dt_interval(hours=(F.col("o_orderkey") % 24 + 1).cast("int"))
    status = first_match(
        [(F.col("o_orderstatus") == "F", F.lit("DELAYED")), (F.col("o_orderstatus") == "P", F.lit("CANCELLED"))],
        F.lit("SCHEDULED"),
    )
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("flight_id"),
        F.concat(F.lit("FL"), F.col("o_orderkey").cast("string")).alias("flight_number"),
        F.col("n_name").alias("origin"),
        F.col("r_name").alias("destination"),
        F.col("o_orderdate").alias("scheduled_dep"),
        (F.col("o_orderdate") + hours).alias("scheduled_arr"),
        F.col("c_mktsegment").alias("aircraft_type"),
        status.alias("status"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("passenger_count"),
        timestamp_lit(EPOCH).alias("created_at"),
    )


def disruption_events(spark: SparkSession, folder: str, *, open_crew_only: bool = False) -> DataFrame:
    """One event per order line. (order, line number) repeats, so event ids repeat as well.

    ``open_crew_only`` says the caller keeps unresolved crew events only. The same condition is then also
    put on the raw columns, because one on computed columns does not reach the parquet reader.
    """
    lines = star_table(spark, folder, "lineitem")
    if open_crew_only:
        unresolved = (F.col("l_linestatus") != "F") | F.col("l_linestatus").isNull() | F.col("l_shipdate").isNull()
        lines = lines.filter(F.col("l_returnflag").isin("R", "A") & unresolved)
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    severity = first_match(
        [(quantity > 47, F.lit("CRITICAL")), (quantity > 38, F.lit("HIGH")), (quantity > 15, F.lit("MEDIUM"))],
        F.lit("LOW"),
    )
    kind = first_match(
        [(flag == "R", F.lit("CREW_SICK")), (flag == "A", F.lit("CREW_TIMEOUT"))], F.lit("WEATHER")
    )
    return lines.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("disruption_id"),
        F.col("l_orderkey").alias("flight_id"),
        F.when(flag != "N", F.col("l_suppkey")).alias("crew_id"),
        kind.alias("disruption_type"),
        severity.alias("severity"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("description"),
        F.floor(quantity * 3).cast("int").alias("estimated_delay_mins"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("cost_estimate"),
        F.col("l_shipdate").alias("reported_at"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("resolved_at"),
        timestamp_lit(EPOCH).alias("created_at"),
    )


def first_load_events(events: DataFrame) -> DataFrame:
    """The events as an earlier load saw them: reported by then, and none resolved yet."""
    return events.filter(F.col("reported_at") < timestamp_lit(FIRST_LOAD_UNTIL)).withColumn(
        "resolved_at", F.lit(None).cast("timestamp_ntz")
    )


def second_load_flights(all_flights: DataFrame) -> DataFrame:
    """The flights as a later load sees them: more passengers, scheduled ones have left."""
    return all_flights.withColumns(
        {
            "passenger_count": F.col("passenger_count") + 10,
            "status": F.when(F.col("status") == "SCHEDULED", F.lit("DEPARTED")).otherwise(F.col("status")),
        }
    )


def crew_members(spark: SparkSession, folder: str) -> DataFrame:
    """One crew member per supplier; some without e-mail or with a malformed one."""
    key = F.col("s_suppkey")
    address = F.concat(F.lower(F.replace("s_name", F.lit("#"), F.lit("."))), F.lit("@crew.example.com"))
    email = F.when(key % 20 == 7, F.replace(address, F.lit("@"), F.lit(""))).when(key % 20 != 9, address)
    return (
        star_table(spark, folder, "supplier")
        .join(star_table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("crew_id"),
            F.concat(F.lit("EMP"), key.cast("string")).alias("employee_id"),
            F.col("s_name").alias("full_name"),
            email.alias("email"),
            _pick(CREW_ROLES, key).alias("role"),
            F.col("n_name").alias("base_airport"),
            _pick(CREW_STATUSES, key).alias("status"),
            F.array(_pick(RATINGS, key), _pick(RATINGS, key + 1)).alias("qualifications"),
            (key % 13).cast("decimal(4,1)").alias("hours_on_duty"),
            F.lit(12).cast("decimal(4,1)").alias("max_duty_hours"),
            timestamp_lit(EPOCH).alias("created_at"),
        )
    )


def marketing_customer(spark: SparkSession, folder: str) -> DataFrame:
    """One contact per order, with invented personal data."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    name = F.concat(F.lit("customer."), customer.cast("string"))
    email = (
        F.when(customer % 40 == 0, F.lit(None).cast("string"))
        .when(customer % 51 == 2, F.concat(name, F.lit("Example.com")))
        .otherwise(F.concat(F.lit("Customer."), customer.cast("string"), F.lit("@Example.com")))
    )
    born = F.add_months(F.col("o_orderdate").cast("date"), (-(customer % 50) * 12).cast("int"))
    people = star_table(spark, folder, "customer").join(
        star_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return (
        star_table(spark, folder, "orders")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.alias("customer_id"),
            F.when(key % 53 != 0, F.col("c_mktsegment")).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.concat(F.lit("900-00-"), key.cast("string")).alias("ssn"),
            F.when(key % 97 != 0, born).alias("date_of_birth"),
            email.alias("email"),
            F.concat(F.lit("555-"), key.cast("string")).alias("phone_number"),
            F.concat(key.cast("string"), F.lit(" Main Street")).alias("address_line1"),
            F.when(key % 2 == 0, F.lit("Suite 1")).alias("address_line2"),
            F.col("n_name").alias("city"),
            F.substring("n_name", 8, 2).alias("state"),
            (customer % 90000 + 10000).cast("string").alias("zip_code"),
        )
    )


def part_edges(spark: SparkSession, folder: str) -> DataFrame:
    """A lineage tree: dataset n is computed from dataset n div 2. Dataset 0 refers to itself."""
    key = F.col("p_partkey")
    return star_table(spark, folder, "part").select(F.floor(key / 2).alias("src"), key.alias("dst"))


# -- lineage event documents ----------------------------------------------------------------------


def _columns(number: Column, as_writer: Column) -> Column:
    """Schema of table ``number``. Writers know one more column of every third table and call the second
    column of every fifth table a text."""

    def column(position: int) -> Column:
        facet_type = _pick(tuple(FACET_TYPES), number + position)
        if position == 1:
            facet_type = F.when(as_writer & (number % 5 == 0), F.lit("text")).otherwise(facet_type)
        return F.struct(F.lit(f"c_{position}").alias("name"), facet_type.alias("type"))

    usual = F.slice(F.array(*[column(position) for position in range(6)]), 1, (number % 4 + 3).cast("int"))
    extra = F.array(F.struct(F.lit("c_new").alias("name"), F.lit("text").alias("type")))
    return F.when(as_writer & (number % 3 == 0), F.concat(usual, extra)).otherwise(usual)


def event_documents(events: DataFrame, *more: Column) -> DataFrame:
    """Two events make a run: the even one is its START, the odd one its end. ``more`` columns of the events stay beside.

    A run reads the tables ``user_id`` and ``props.k`` and writes table ``user_id div 2``, under one of two
    addresses of the same database. Ends carry column lineage, partly through helper datasets.
    """
    schema_of = event_schema()
    lineage_type = schema_of["inputs"].dataType.elementType["facets"].dataType["columnLineage"].dataType
    engine_type = schema_of["run"].dataType["facets"].dataType["processing_engine"].dataType
    number = F.floor(F.col("event_id") / 2)
    kind = F.col("event_type")
    is_start = F.col("event_id") % 2 == 0
    run_id = F.concat(F.lit("run-"), number.cast("string"))
    job = F.concat(F.lit("job_"), (number % 100).cast("string"))
    at_a = kind.isin("click", "view")
    host = F.when(at_a, F.lit("postgres://warehouse-a:5432")).otherwise(F.lit("postgres://warehouse-b:5432"))
    schema = F.when(at_a, F.lit("defaultdb.public.")).otherwise(F.lit("postgres.public."))
    second = F.regexp_extract("props", r"(\d+)", 1).cast("bigint")

    def table(n: Column) -> Column:
        return F.concat(schema, F.lit("t_"), n.cast("string"))

    def came_from(*sources: tuple[str, Column]) -> Column:
        fields = [
            F.struct(F.lit(column).alias("field"), name.alias("name"), host.alias("namespace"))
            for column, name in sources
        ]
        return F.struct(F.array(*fields).alias("inputFields"))

    helper, subquery = F.concat(schema, F.lit("tmp_staging")), F.concat(schema, F.lit("with_risk"))
    first_input, second_input = table(F.col("user_id")), table(second)
    lineage = F.create_map(
        F.lit("c_1"),
        came_from(("c_1", first_input)),
        F.lit("c_2"),
        came_from(("c_2", first_input), ("c_0", second_input)),
        F.lit("risk"),
        came_from(("c_1", helper), ("c_9", helper)),
        F.lit("x_extra"),
        came_from(("x_extra", subquery)),
        # through two helpers, one of whose sources leads nowhere
        F.lit("c_0"),
        came_from(("stage_a", helper)),
        F.lit("stage_a"),
        came_from(("c_0", first_input), ("stage_b", subquery)),
        F.lit("stage_b"),
        came_from(("c_2", second_input), ("gone", subquery)),
    )

    def dataset(n: Column, as_writer: bool, fields: Column | None = None) -> Column:
        if fields is None:
            known = F.lit(None).cast(lineage_type)
        else:
            known = F.when(~is_start, F.struct(fields.alias("fields")))
        return F.struct(
            host.alias("namespace"),
            table(n).alias("name"),
            F.struct(
                F.struct(_columns(n, F.lit(as_writer)).alias("fields")).alias("schema"),
                known.alias("columnLineage"),
            ).alias("facets"),
        )

    started = iso_seconds(F.col("ts"))
    trigger = iso_micros(add_millis(F.col("ts"), 1000))
    run_name = F.concat(F.lit("manual__"), trigger)
    log_url = F.concat(
        F.lit("http://scheduler.example.com/dags/"),
        job,
        F.lit("/runs/"),
        F.url_encode(run_name),
        F.lit("/tasks/load?try_number=1"),
    )
    scheduler = F.struct(
        F.concat(F.lit("task-"), number.cast("string")).alias("taskUuid"),
        F.struct(
            run_name.alias("run_id"),
            trigger.alias("run_after"),
            trigger.alias("start_date"),
            started.alias("logical_date"),
            started.alias("data_interval_start"),
            started.alias("data_interval_end"),
        ).alias("dagRun"),
        F.struct(log_url.alias("log_url"), F.lit(1).alias("try_number")).alias("taskInstance"),
    )
    parent_id = F.when(kind == "signup", run_id).otherwise(
        F.concat(F.lit("dag-"), F.floor(number / 10).cast("string"))
    )
    parent_job = F.struct(F.lit("parent").alias("name"), F.lit("scheduler").alias("namespace"))
    parent_run = F.struct(parent_id.alias("runId"))
    parent = F.struct(
        parent_job.alias("job"),
        parent_run.alias("run"),
        F.struct(parent_job.alias("job"), parent_run.alias("run")).alias("root"),
    )
    state = F.when(is_start, F.lit("START")).when(kind == "error", F.lit("FAIL")).otherwise(F.lit("COMPLETE"))
    fields = {
        "eventTime": iso_micros(F.col("ts")),
        "eventType": state,
        "producer": F.lit("https://scheduler.example.com"),
        "schemaURL": F.lit(None).cast("string"),
        "job": F.struct(
            F.lit("scheduler").alias("namespace"),
            job.alias("name"),
            F.lit(None).cast(schema_of["job"].dataType["facets"].dataType).alias("facets"),
        ),
        "run": F.struct(
            run_id.alias("runId"),
            F.struct(
                F.struct(started.alias("nominalStartTime"), started.alias("nominalEndTime")).alias("nominalTime"),
                parent.alias("parent"),
                F.lit(None).cast(engine_type).alias("processing_engine"),
                F.when(number % 5 != 0, scheduler).alias(SCHEDULER_FACET),
            ).alias("facets"),
        ),
        "inputs": F.array(dataset(F.col("user_id"), False), dataset(second, False)),
        "outputs": F.array(dataset(F.floor(F.col("user_id") / 2), True, lineage)),
    }
    # built with the exact types: a cast of a whole struct would keep the optimizer from pruning its fields
    return events.select(*[fields[name].alias(name) for name in schema_of.names], *more)


def dataset_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """(name, alias): every table under its two addresses, and tables 4n to 4n + 3 of the first address in a chain."""
    events = star_table(spark, folder, "events")
    second = F.regexp_extract("props", r"(\d+)", 1).cast("bigint")
    numbers = events.select(F.explode(F.array("user_id", second, F.floor(F.col("user_id") / 2))).alias("n")).distinct()

    def at(address: str, n: Column) -> Column:
        return F.concat(F.lit(address), n.cast("string"))

    here, there, n = "postgres://warehouse-a:5432/defaultdb.public.t_", "postgres://warehouse-b:5432/postgres.public.t_", F.col("n")
    pairs = F.array(
        F.struct(at(here, n).alias("name"), at(there, n).alias("alias")),
        F.when(n % 4 != 3, F.struct(at(here, n).alias("name"), at(here, n + 1).alias("alias"))),
    )
    return numbers.select(F.inline(F.filter(pairs, lambda pair: pair.isNotNull())))


#: Events that one task makes documents of; more events make more tasks, not longer ones.
EVENTS_PER_TASK = 50_000


def _spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores, and over more tasks the more there are, where their files would make fewer: a document is
    many times its row. The count is taken from the files' footers."""
    wanted = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // EVENTS_PER_TASK))
    return rows.repartition(wanted) if rows.rdd.getNumPartitions() < wanted else rows


def lineage_events(spark: SparkSession, folder: str) -> DataFrame:
    return event_documents(_spread(star_table(spark, folder, "events")))


def lineage_event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as a stream of files, in which every purchase event is delivered twice."""
    # a pattern instead of a plain name, so that the table may be one file or a folder of files
    raw = spark.readStream.schema(STAR_SCHEMAS["events"]).parquet(f"{folder}/event[s].parquet")
    copies = F.when(F.col("event_type") == "purchase", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return event_documents(raw.withColumn("delivery", F.explode(copies)))


def full_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The events with fields that no schema here declares: at the top, in a facet of the run, in facets of the inputs."""
    second = F.regexp_extract("props", r"(\d+)", 1).cast("bigint")
    custom = F.struct(
        F.concat(F.lit("https://example.com/"), F.col("event_type")).alias("_producer"),
        F.struct(F.array(F.struct(iso_micros(F.col("ts")).alias("at"))).alias("col1")).alias("deep"),
        F.lit(True).alias("kept"),
        F.parse_json("props").alias("props"),
        F.array(F.col("user_id"), second).alias("tags"),
    )
    documents = event_documents(_spread(star_table(spark, folder, "events")), custom.alias("custom"), F.col("event_id"))
    rows = F.struct((F.col("event_id") % 1000).alias("rowCount"))
    return documents.select(
        "eventTime",
        "eventType",
        "producer",
        F.lit("application/json").alias("contentType"),
        "job",
        F.col("run").withField("facets.custom", F.col("custom")).alias("run"),
        F.transform("inputs", lambda d: d.withField("facets.statistics", rows)).alias("inputs"),
        "outputs",
    )


#: Batches that the events are delivered in, and the run of the two events that close the delivery.
DELIVERIES = 6
CLOSING_RUN = "run--1"
#: Events that a file of a delivery holds; more events make more files, not larger ones.
EVENTS_PER_FILE = 200_000


def delivered_events(spark: SparkSession, folder: str, place: str) -> int:
    """Write the events as one delivery after another below ``place``, in the order of their ids; the files of each delivery.

    Ends of purchases come two deliveries later, if there are as many; every purchase comes twice. Two more deliveries hold an event of
    each kind of a run of its own, 30 and 60 days later, which tell a stream that the time of all others is over. All
    deliveries have as many files, so that a stream tells them apart by counting; where there are not rows enough, some are empty.
    """
    raw = star_table(spark, folder, "events")
    counted = raw.agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last")).first()
    sliced = F.floor(F.col("event_id") * DELIVERIES / max(counted["n"], 1))
    is_purchase = F.col("event_type") == "purchase"
    later = is_purchase & (F.col("event_id") % 2 == 1) & (sliced + 2 < DELIVERIES)
    copies = F.when(is_purchase, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    sent = raw.withColumn("delivery", F.when(later, sliced + 2).otherwise(sliced)).withColumn("copy", F.explode(copies)).drop("copy")
    files = max(1, -(-counted["n"] // (DELIVERIES * EVENTS_PER_FILE)))
    for n in range(DELIVERIES):
        rows = sent.filter(F.col("delivery") == n).drop("delivery")
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(place)
        _fill_up(spark, place, files * (n + 1), raw.schema)
    if counted["n"]:
        for place_in_order, days in enumerate((30, 60), DELIVERIES + 1):
            moved = {"ts": F.lit(counted["last"]).cast("timestamp_ntz") + F.make_dt_interval(F.lit(days)), "event_type": F.lit("click")}
            one = raw.limit(1).withColumns(moved).drop("event_id").withColumn("event_id", F.explode(F.array(*[F.lit(n).cast("bigint") for n in (-2, -1)])))
            one.select(*raw.columns).coalesce(1).write.mode("append").parquet(place)
            _fill_up(spark, place, files * place_in_order, raw.schema)
    return files


def _fill_up(spark: SparkSession, place: str, wanted: int, schema: T.StructType) -> None:
    """Add files without rows until there are ``wanted`` below ``place``: one is written, the others are copies of it."""
    hadoop = spark._jvm.org.apache.hadoop
    folder, conf = hadoop.fs.Path(place), spark._jsc.hadoopConfiguration()
    store = folder.getFileSystem(conf)

    def files(path) -> list:
        return [f.getPath() for f in store.listStatus(path) if f.getPath().getName().startswith("part-")]

    missing = wanted - len(files(folder))
    if missing > 0:
        empty = f"{place}-empty-{uuid.uuid4().hex}"
        spark.createDataFrame([], schema).coalesce(1).write.parquet(empty)
        (source,) = files(hadoop.fs.Path(empty))
        for _ in range(missing):
            hadoop.fs.FileUtil.copy(store, source, store, hadoop.fs.Path(f"{place}/part-{uuid.uuid4().hex}.parquet"), False, conf)


def delivered_event_stream(spark: SparkSession, place: str, files: int = 1) -> DataFrame:
    """The documents of ``delivered_events``, one delivery, of as many ``files``, a batch."""
    raw = spark.readStream.schema(STAR_SCHEMAS["events"]).option("maxFilesPerTrigger", files).parquet(place)
    return event_documents(raw)
