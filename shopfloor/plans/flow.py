"""End-to-end run: events -> bronze (streaming) -> silver -> checks -> gold ->
checks -> serving.

Every hand-off between stages is a table in shared storage, so each stage
reads what the previous one wrote (pruned and pushed-down scans), a lost
executor only recomputes from the last written table, and no stage keeps a
long lineage.  Stage order follows the original schedule; checks never stop
the run unless ``fail_on`` asks for it.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.operators import dimensions as dims
from shopfloor.operators import events as evt
from shopfloor.operators import quality as dq
from shopfloor.operators import serving
from shopfloor.operators import silver
from shopfloor.plans import gold
from shopfloor.sinks import compaction, files, jdbc, versioned
from shopfloor.sources import streams
from shopfloor.streaming import bronze as bronze_stream
from shopfloor.streaming.silver_incremental import start_incremental_silver, with_first_seen_month

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layout:
    """Where each table lives under one root folder (shared storage)."""

    root: str

    def p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def order_topic(self) -> str:
        return self.p("topics", evt.ORDER_TOPIC)

    @property
    def customer_topic(self) -> str:
        return self.p("topics", evt.CUSTOMER_TOPIC)

    @property
    def bronze_orders(self) -> str:
        return self.p("bronze", "orders")

    @property
    def bronze_customers(self) -> str:
        return self.p("bronze", "customers")

    def compacted(self, name: str) -> str:
        return self.p("bronze_compacted", name)

    def checkpoint(self, name: str) -> str:
        return self.p("checkpoints", name)

    @property
    def silver_orders(self) -> str:
        return self.p("silver", "orders")

    @property
    def silver_customers(self) -> str:
        return self.p("silver", "customers")

    def dimension(self, name: str) -> str:
        return self.p("gold", "dimensions", name)

    @property
    def fact(self) -> str:
        return self.p("gold", "facts", "fact_order_items")

    def side(self, name: str) -> str:
        return self.p("silver", "sides", name)

    def rollup(self, name: str) -> str:
        return self.p("gold", "rollups", name)

    def report(self, name: str) -> str:
        return self.p("gold", gold.REPORT_GROUPS[name], name)

    @property
    def metrics(self) -> str:
        return self.p("gold", "data_quality_metrics")

    @property
    def orphan_orders(self) -> str:
        return self.p("gold", "data_quality_issues", "orphan_orders")


def run_concurrently(tasks: Sequence[Callable[[], object]], parallel: int = 4) -> list[object]:
    """Submit independent Spark jobs from a few driver threads.  Spark runs
    jobs of different threads at the same time, so small jobs (dimension and
    report writes) share the executors instead of queueing one by one.
    Any failure is raised."""
    if parallel <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def publish_events(raw: DataFrame, layout: Layout, partitions: int = 8) -> tuple[int, int]:
    """Producer stand-in: write order and customer events as Kafka-shaped
    records into the topic folders the bronze streams read.

    Returns (raw lines, distinct identified customers), observed while the
    events are written, so the checks need not scan the raw input again.
    """
    raw_seen, raw_obs = files.counted(raw, "raw_lines")
    orders = streams.replay_records(evt.order_records(evt.order_events(raw_seen)), evt.ORDER_TOPIC, partitions)
    customers, cust_obs = files.counted(
        streams.replay_records(evt.customer_records(evt.customer_events(raw)), evt.CUSTOMER_TOPIC, partitions),
        "customer_events",
    )
    run_concurrently(
        [
            lambda: orders.write.mode("append").parquet(layout.order_topic),
            lambda: customers.write.mode("append").parquet(layout.customer_topic),
        ],
        parallel=2,
    )
    return int(raw_obs.get["rows"]), int(cust_obs.get["rows"])


@dataclass(frozen=True)
class KafkaTopics:
    """SRC-01/02: the two topics of a broker; ``max_offsets_per_trigger`` bounds a micro-batch."""

    bootstrap_servers: str
    orders: str = evt.ORDER_TOPIC
    customers: str = evt.CUSTOMER_TOPIC
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int | None = None
    options: Mapping[str, str] | None = None

    def open(self, spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
        return {
            name: streams.kafka_stream(spark, self.bootstrap_servers, topic, self.starting_offsets,
                                       self.max_offsets_per_trigger, dict(self.options or {}))
            for name, topic in (("orders", self.orders), ("customers", self.customers))
        }


@dataclass(frozen=True)
class FolderTopics:
    """Topics as folders of Kafka-shaped Parquet records (by default those under
    the run's root); ``max_files_per_trigger`` bounds a micro-batch."""

    orders: str | None = None
    customers: str | None = None
    max_files_per_trigger: int | None = None

    def open(self, spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
        paths = {"orders": self.orders or layout.order_topic, "customers": self.customers or layout.customer_topic}
        return {name: streams.record_file_stream(spark, p, max_files_per_trigger=self.max_files_per_trigger)
                for name, p in paths.items()}


def ingest_bronze(spark: SparkSession, layout: Layout, trigger: Mapping[str, object] | None = None,
                  source: KafkaTopics | FolderTopics | None = None) -> dict[str, int]:
    """Both bronze streams in one session; waits for both; returns ingested
    rows per stream."""
    trigger = trigger or bronze_stream.AVAILABLE_NOW
    counter = bronze_stream.IngestCounter()
    spark.streams.addListener(counter)
    try:
        sinks = {"orders": layout.bronze_orders, "customers": layout.bronze_customers}
        queries = [
            bronze_stream.start_bronze(records, sinks[name], layout.checkpoint(name), trigger, query_name=f"bronze_{name}")
            for name, records in (source or FolderTopics()).open(spark, layout).items()
        ]
        bronze_stream.await_all(spark, queries)
        counter.wait(queries)
    finally:
        spark.streams.removeListener(counter)
    return {q.name: counter.rows.get(q.name, 0) for q in queries}


def bronze_tables(spark: SparkSession, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """Bronze orders and customers, small files through their compacted ones."""
    return (compaction.read(spark, layout.bronze_orders, layout.compacted("orders")),
            compaction.read(spark, layout.bronze_customers, layout.compacted("customers")))


def compact_bronze(spark: SparkSession, layout: Layout, target_bytes: int = compaction.TARGET_BYTES) -> dict[str, dict]:
    """Rewrites the small files that the bronze streams have left so far."""
    sinks = {"orders": layout.bronze_orders, "customers": layout.bronze_customers}
    return {n: compaction.compact(spark, path, layout.compacted(n), target_bytes) for n, path in sinks.items()}


def silver_tables(spark: SparkSession, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """The current silver orders and customers."""
    so, sc = versioned.read(spark, layout.silver_orders), versioned.read(spark, layout.silver_customers)
    if so is None or sc is None:
        raise FileNotFoundError(f"no silver tables under {layout.root}")
    return so, sc.drop("year", "month")


def build_silver(spark: SparkSession, layout: Layout, silver_partitions: int | None = None,
                 parallel: int = 2) -> dict[str, int]:
    """Silver orders and customers, both as new versions of all their months;
    returns the rows written per table and the check metrics, observed by the
    tasks that write."""
    bronze_orders, bronze_customers = bronze_tables(spark, layout)
    orders = silver.silver_orders(bronze_orders)
    customers = with_first_seen_month(silver.silver_customers(bronze_customers))
    batch = f"full-{uuid.uuid4().hex}"
    seen = run_concurrently(
        [
            lambda: versioned.write(orders, layout.silver_orders, batch, True, dq.order_metrics(), silver_partitions),
            lambda: versioned.write(customers, layout.silver_customers, batch, True, dq.customer_metrics()),
        ],
        parallel,
    )
    written = seen[0] | seen[1]
    written.pop("rows")
    log.info("silver written: %s", written)
    return written


def build_silver_incremental(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Silver by merging the new bronze files into the months they touch
    (streams with their own checkpoints; a rerun with no new bronze is a
    no-op).  Returns the stored row counts."""
    queries = [
        start_incremental_silver(spark, layout.bronze_orders, layout.silver_orders,
                                 layout.checkpoint("silver_orders"), bronze_stream.AVAILABLE_NOW, kind="orders"),
        start_incremental_silver(spark, layout.bronze_customers, layout.silver_customers,
                                 layout.checkpoint("silver_customers"), bronze_stream.AVAILABLE_NOW, kind="customers"),
    ]
    bronze_stream.await_all(spark, queries)
    so, sc = silver_tables(spark, layout)
    return {"silver_orders": so.count(), "silver_customers": sc.count()}


def build_sides(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The side tables of silver orders that checks and dimensions read."""
    so, _ = silver_tables(spark, layout)
    run_concurrently([lambda n=n, f=f: files.write_table(f(so), layout.side(n)) for n, f in dq.SIDES.items()])
    return {n: spark.read.parquet(layout.side(n)) for n in dq.SIDES}


def silver_quality(spark: SparkSession, layout: Layout, run_id: str, raw: DataFrame | None = None,
                   raw_counts: tuple[int, int] | None = None, observed: Mapping[str, object] | None = None,
                   sides: Mapping[str, DataFrame] | None = None) -> DataFrame:
    so, sc = silver_tables(spark, layout)
    checks = dq.silver_checks(
        *bronze_tables(spark, layout), so, sc,
        raw=None if raw_counts else raw, raw_counts=raw_counts, observed=observed, sides=sides,
    )
    files.append_metrics(dq.with_run(checks, run_id), layout.metrics)
    recorded = files.read_metrics(spark, layout.metrics).filter((F.col("run_id") == run_id) & (F.col("layer") != "gold"))
    # Quarantine only when the recorded check found orphans: the common clean
    # run costs no second anti-join over silver.
    orphan_check = recorded.filter(F.col("check_name") == "referential_integrity_customer_id").select("actual")
    if orphan_check.filter(F.col("actual") != "0").limit(1).count():
        path = files.quarantine(dq.orphan_orders(so, sc), layout.orphan_orders, run_id)
        log.warning("orphan orders quarantined at %s", path)
    return recorded


def build_gold(spark: SparkSession, layout: Layout, cohort_years: Sequence[int] | None, parallel: int = 8,
               sides: Mapping[str, DataFrame] | None = None) -> dict:
    """Dimensions and fact from silver, then the roll-ups of the stored fact
    (two scans of it) and every report from the smallest roll-up that holds it.
    Returns the fact's check metrics, observed while it is written."""
    from shopfloor.operators import facts

    so, sc = silver_tables(spark, layout)
    d = gold.dimensions(so, sc, cohort_years, sides)
    writes = [lambda n=n, df=df: files.write_table(df, layout.dimension(n)) for n, df in d.items()]
    writes.append(lambda: files.write_partitioned(facts.fact_order_items(so), layout.fact, metrics=dq.fact_metrics()))
    seen = run_concurrently(writes, parallel)[-1]
    fact = spark.read.parquet(layout.fact)
    stored = {name: spark.read.parquet(layout.dimension(name)) for name in gold.DIMENSIONS}

    def store(df: DataFrame, name: str) -> DataFrame:
        files.write_table(df, layout.rollup(name))
        return spark.read.parquet(layout.rollup(name))

    made = gold.rollups(fact, store)

    def write_report(name: str) -> None:
        files.write_table(gold.reports(made, stored, [name])[name], layout.report(name))

    run_concurrently([lambda n=n: write_report(n) for n in gold.REPORTS], parallel)
    return seen


def gold_quality(spark: SparkSession, layout: Layout, run_id: str, observed: Mapping[str, object] | None = None,
                 sides: Mapping[str, DataFrame] | None = None) -> DataFrame:
    r = lambda n: spark.read.parquet(layout.report(n))
    d = lambda n: spark.read.parquet(layout.dimension(n))
    checks = dq.gold_checks(
        spark.read.parquet(layout.fact), d("dim_product"), d("dim_customer"), d("dim_date"), r("revenue_yearly"),
        r("revenue_monthly"), r("aov_monthly"), r("customer_lifetime_value"), r("retention_rate"),
        r("basket_size_monthly"), r("new_vs_returning"), silver_orders=silver_tables(spark, layout)[0],
        observed=observed, sides=sides,
    )
    files.append_metrics(dq.with_run(checks, run_id), layout.metrics)
    return files.read_metrics(spark, layout.metrics).filter((F.col("run_id") == run_id) & (F.col("layer") == "gold"))


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """Expose every stored gold table (dimensions, fact, reports, metrics) as
    a temporary view, so dashboard SQL can run on the lake with Spark SQL
    (each view is a pruned, pushed-down Parquet scan)."""
    tables = {name: layout.dimension(name) for name in gold.DIMENSIONS}
    tables["fact_order_items"] = layout.fact
    tables.update({name: layout.report(name) for name in gold.REPORTS})
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    files.read_metrics(spark, layout.metrics).createOrReplaceTempView("data_quality_metrics")
    return [*tables, "data_quality_metrics"]


def publish_serving(spark: SparkSession, layout: Layout, url: str, properties: Mapping[str, str] | None = None,
                    num_partitions: int | None = 4) -> dict[str, int]:
    tables = {name: spark.read.parquet(layout.report(name)) for name in serving.SERVING_TABLES}
    return jdbc.publish(tables, url, properties, num_partitions=num_partitions)


def run(
    spark: SparkSession,
    raw: DataFrame | None,
    root: str,
    run_id: str | None = None,
    cohort_years: Sequence[int] | None = dims.DEFAULT_COHORT_YEARS,
    jdbc_url: str | None = None,
    jdbc_properties: Mapping[str, str] | None = None,
    fail_on: str | None = None,
    publish: bool = False,
    incremental_silver: bool = False,
    source: KafkaTopics | FolderTopics | None = None,
    trigger: Mapping[str, object] | None = None,
    compact: bool = False,
) -> dict[str, object]:
    """Run every stage; returns ingest counts, check totals by status and
    serving row counts.  Events come from ``source`` (a broker's topics, or
    folders of records; by default the folders under ``root``).  ``publish``
    replays ``raw`` into those folders first, in place of a producer; without it
    ``raw``, if given, only supplies the expected counts of the checks.
    ``fail_on="FAIL"`` raises after the checks if any check failed (off by
    default, as in the original schedule).  ``incremental_silver`` merges only
    new bronze into silver instead of rebuilding it; ``compact`` rewrites the
    streams' small files before silver is built."""
    layout = Layout(root)
    run_id = run_id or dq.new_run_id()
    stages: dict[str, float] = {}

    def timed(name: str, fn: Callable[[], object]) -> object:
        t0 = time.perf_counter()
        try:
            return fn()
        finally:
            stages[name] = round(time.perf_counter() - t0, 3)

    raw_counts = timed("publish_events", lambda: publish_events(raw, layout)) if publish else None
    ingested = timed("bronze_streams", lambda: ingest_bronze(spark, layout, trigger, source))
    if compact:
        timed("compaction", lambda: compact_bronze(spark, layout))
    seen = timed("silver", lambda: build_silver_incremental(spark, layout) if incremental_silver
                 else build_silver(spark, layout))
    observed = {} if incremental_silver else seen
    sides = timed("side_tables", lambda: build_sides(spark, layout))
    # Silver checks and the gold build only read stored silver and do not
    # depend on each other: run them side by side.
    silver_metrics, fact_seen = timed("silver_checks_and_gold", lambda: run_concurrently(
        [
            lambda: silver_quality(spark, layout, run_id, raw, raw_counts, observed, sides),
            lambda: build_gold(spark, layout, cohort_years, sides=sides),
        ],
        parallel=2,
    ))
    gold_metrics = timed("gold_checks", lambda: gold_quality(spark, layout, run_id, observed | fact_seen, sides))
    totals = {r["status"]: r["checks"] for r in dq.summary(silver_metrics.unionByName(gold_metrics)).collect()}
    served = timed("serving", lambda: publish_serving(spark, layout, jdbc_url, jdbc_properties)) if jdbc_url else {}
    if fail_on and totals.get(fail_on, 0):
        raise RuntimeError(f"{totals[fail_on]} checks ended {fail_on} in run {run_id}")
    written = {name: seen[name] for name in ("silver_orders", "silver_customers")}
    return {"run_id": run_id, "ingested": ingested, "written": written, "checks": totals, "served": served,
            "stages": stages, "layout": layout}
