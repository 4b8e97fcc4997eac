"""CDC intake with Structured Streaming.

landing (JSON files) --readStream/availableNow--> bronze (parquet,
partitioned by entity_name/event_date, append-only) --> silver (decoded,
one row per event and attribute) --> gold appliers (operators.cdc_apply).

* Intake is an incremental file stream; ``trigger(availableNow=True)`` turns
  an hourly run into a bounded job that stops by itself, and the checkpoint
  makes a rerun pick up only new files (exactly-once into the file sink).
* Bronze keeps every event, late ones included: the stream is stateless,
  so no watermark drops anything. Replayed events (same event_id) are
  removed when silver is built; all appliers are idempotent anyway.
* ``run_cdc_batches`` drives the gold appliers from ``foreachBatch`` with
  the batch id as the version of each output table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.publish import written
from starloom.functions.storage import CODEC, if_small, materialize
from starloom.sources.cdc_events import CDC_SCHEMA, ENTITY_ATTRIBUTES
from starloom.session import checkpoint_root

c = F.col
PAYLOAD_MAP = T.MapType(T.StringType(), T.StringType())
# Event times keep microseconds through the JSON files (Spark's default
# JSON format for timestamp_ntz stops at milliseconds).
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def land_events(events: DataFrame, landing_dir: str, files: int | None = None) -> None:
    """Write change events as JSON lines, in files of arrival order (what an
    upstream system emitting hourly files would leave behind): ``files`` of
    them, by default as many as the volume needs (AQE sizes them)."""
    by = ["arrival_seq"] if files is None else [files, "arrival_seq"]
    (
        events.repartitionByRange(*by)
        .sortWithinPartitions("arrival_seq")
        .write.mode("append")
        .options(compression="gzip", **JSON_OPTIONS)
        .json(landing_dir)
    )


def read_landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(CDC_SCHEMA).options(**JSON_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(landing_dir)


def to_bronze(stream: DataFrame, dedup_watermark: str | None = None) -> DataFrame:
    """Add the partition date. Optional in-stream replay dedup: events older
    than the watermark are then dropped by Spark, so only use it with a delay
    longer than any expected lateness."""
    out = stream.withColumn("event_date", F.to_date("event_time"))
    if dedup_watermark:
        out = (
            out.withColumn("_wm_time", c("event_time").cast("timestamp"))
            .withColumn("_same", _whole_event())
            .withWatermark("_wm_time", dedup_watermark)
            .dropDuplicatesWithinWatermark(["event_id", "_same"])
            .drop("_wm_time", "_same")
        )
    return out


def lateness(events: DataFrame) -> str:
    """A watermark delay that no event of a feed exceeds: its span in days."""
    low, high = events.agg(F.min("event_time"), F.max("event_time")).first()
    return f"{(high - low).days + 1 if low is not None else 1} days"


def _whole_event() -> Column:
    """Tells events without an id apart: their whole content."""
    return F.when(c("event_id").isNull(), F.to_json(F.struct(*[f.name for f in CDC_SCHEMA.fields])))


def run_bronze(
    spark: SparkSession,
    landing_dir: str,
    bronze_dir: str,
    checkpoint_dir: str,
    max_files_per_trigger: int | None = None,
    dedup_watermark: str | None = None,
) -> None:
    """One availableNow run of landing -> bronze (returns when caught up)."""
    events = to_bronze(read_landing_stream(spark, landing_dir, max_files_per_trigger), dedup_watermark)
    # one file per (entity, date) and slice instead of one from every task; a
    # day's events, most of a batch, are spread over several slices
    slices = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    events = events.repartition("entity_name", "event_date", F.pmod(F.xxhash64("event_id", "arrival_seq"), F.lit(slices)))
    q = (
        events.writeStream.format("parquet")
        .partitionBy("entity_name", "event_date")
        .option("checkpointLocation", checkpoint_dir)
        .option("compression", CODEC)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(bronze_dir)
    )
    q.awaitTermination()


class CompactedBronze:
    """Bronze with the small files of many micro-batches packed into larger ones.

    A streaming sink's files must stay as they are, so packed copies are kept beside
    it. ``compact`` takes the files that no packed one holds yet, packs those of one
    (entity, date) into bins of at most ``target_bytes`` (one larger file is a bin of
    its own), and writes each bin as one file; a small table, written last, lists the
    files that are held. ``read`` reads the packed files and those of bronze that
    are not listed, so every event is read once whatever was cut short."""

    def __init__(self, spark: SparkSession, bronze_dir: str, packed_dir: str, target_bytes: int = 128 << 20):
        self.spark, self.bronze, self.packed, self.target = spark, bronze_dir, packed_dir.rstrip("/"), target_bytes

    def _source(self) -> DataFrame:
        return self.spark.read.parquet(self.bronze).select("*", c("_metadata.file_path").alias("_path"), c("_metadata.file_size").alias("_size"))

    def _lists(self) -> DataFrame | None:
        path = f"{self.packed}/_files"
        return self.spark.read.parquet(path) if written(self.spark, path) else None

    def _number(self) -> int:
        lists = self._lists()
        return lists.agg(F.max("number")).first()[0] if lists is not None else 0

    def held(self) -> DataFrame:
        """(file, attempt) of the newest list."""
        lists = self._lists()
        if lists is None:
            return self.spark.createDataFrame([], "file string, attempt string")
        return lists.filter(c("number") == self._number()).select("file", "attempt")

    def bins(self) -> DataFrame:
        """(entity_name, event_date, _path, _bin) of the files to be packed: what is
        not held, if it is small. Sizes are added up in the order of the names;
        where the sum passes a multiple of the target the next bin begins."""
        files = self._source().select("entity_name", "event_date", "_path", "_size").distinct()
        files = files.join(self.held(), c("_path") == c("file"), "left_anti").filter(c("_size") < self.target)
        w = Window.partitionBy("entity_name", "event_date").orderBy("_path").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        half = max(1, self.target // 2)  # a bin of files under half the target that begin in one half fits the target
        begin = F.sum("_size").over(w) - c("_size")
        small = files.filter(c("_size") <= half).withColumn("_bin", F.floor(begin / half))
        return small.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("entity_name", "event_date", "_bin"))).filter("_n > 1").drop("_n", "_size")

    def compact(self) -> int:
        """Pack what there is to pack; returns the number of files packed."""
        bins = materialize(self.bins(), "bronze-bins")
        n = bins.count()
        if n:
            attempt = uuid.uuid4().hex[:12]
            rows = self._source().join(if_small(bins.select("_path", "_bin")), "_path").drop("_path", "_size")
            rows = rows.repartition("entity_name", "event_date", "_bin").sortWithinPartitions("entity_name", "event_date", "_bin")
            rows.write.partitionBy("entity_name", "event_date", "_bin").parquet(f"{self.packed}/attempt={attempt}")
            held = self.held().unionByName(bins.select(c("_path").alias("file"), F.lit(attempt).alias("attempt")))
            held.withColumn("number", F.lit(self._number() + 1).cast("long")).coalesce(1).write.mode("append").parquet(f"{self.packed}/_files")
        return n

    def read(self) -> DataFrame:
        rest = self._source().join(if_small(materialize(self.held().select("file"), "bronze-held")), c("_path") == c("file"), "left_anti")
        columns = [*[c(f.name).cast(f.dataType) for f in CDC_SCHEMA.fields], c("event_date").cast("date").alias("event_date")]
        out = rest.select(*columns)
        for a in sorted(r.attempt for r in self.held().select("attempt").distinct().collect()):  # one a run
            out = out.unionByName(self.spark.read.parquet(f"{self.packed}/attempt={a}").select(*columns))
        return out


BRONZE_COLUMNS = [f.name for f in CDC_SCHEMA.fields] + ["event_date"]


def read_bronze(spark: SparkSession, bronze_dir: str) -> DataFrame:
    df = spark.read.parquet(bronze_dir)
    return df.select(
        *[c(f.name).cast(f.dataType) for f in CDC_SCHEMA.fields], c("event_date").cast("date").alias("event_date")
    )


def dedup_events(bronze: DataFrame) -> DataFrame:
    """Drop replayed copies of an event: the same event_id or, without an id,
    the same whole event. Of copies that differ the least row stays, so the
    result is the same on every run. event_id is a near-uniform key."""
    row = F.struct("arrival_seq", *[x for x in bronze.columns if x != "arrival_seq"])
    kept = bronze.withColumn("_same", _whole_event()).groupBy("event_id", "_same").agg(F.min(row).alias("_r"))
    return kept.select(*[c("_r")[x].alias(x) for x in bronze.columns])


#: Entities whose key is 'order|number'.
PAIR_KEYS = ("OrderItem", "Payment")


def fault() -> Column:
    """Why an event cannot be applied, NULL if it can."""
    parts = F.split("primary_key", r"\|")
    pair = F.get(parts, 0).isNotNull() & F.get(parts, 1).try_cast("int").isNotNull()
    return (
        F.when(c("entity_name").isNull() | ~c("entity_name").isin(*ENTITY_ATTRIBUTES), "unknown entity")
        .when(c("primary_key").isNull(), "no key")
        .when(c("entity_name").isin(*PAIR_KEYS) & ~pair, "malformed key")
        .when(c("event_time").isNull(), "no time")
        .when(c("operation").isNull() | ~c("operation").isin("insert", "update", "delete"), "unknown operation")
        .when(c("payload").isNotNull() & F.from_json("payload", PAYLOAD_MAP).isNull(), "malformed payload")
    )


def quarantine(bronze: DataFrame) -> DataFrame:
    """Replay-free events that no applier can take, with the reason."""
    return dedup_events(bronze).withColumn("reason", fault()).filter("reason is not null")


def quarantine_counts(bronze: DataFrame) -> DataFrame:
    return quarantine(bronze).groupBy("entity_name", "reason").agg(F.count(F.lit(1)).alias("n_events"))


def decoded(bronze: DataFrame) -> DataFrame:
    """Events with the payload parsed to ``map<string,string>``: a key that
    is present with a null value is an explicit null; an absent key means
    'unchanged'."""
    events = dedup_events(bronze).filter(fault().isNull())
    return events.withColumn("changes", F.from_json("payload", PAYLOAD_MAP))


def silver(events: DataFrame) -> DataFrame:
    """One row per (event, changed attribute); events without attributes
    (deletes) keep one row with NULL attribute. ``events``: bronze or the
    decoded silver table."""
    d = events if "changes" in events.columns else decoded(events)
    return d.select(
        "entity_name",
        "primary_key",
        "event_time",
        "event_id",
        "arrival_seq",
        "operation",
        "event_date",
        F.explode_outer("changes").alias("attribute", "value"),
    )


def build_silver(bronze: DataFrame) -> DataFrame:
    """The silver table: replay-free, payload parsed; written once per run so
    every entity applier reads it instead of re-decoding bronze."""
    return materialize(decoded(bronze), "cdc-silver-decoded", partition_by=["entity_name"], spread=["arrival_seq"])


def entity_changes(events: DataFrame, entity: str, attributes: list[str]) -> DataFrame:
    """Decoded events of one entity, wide: ``has_<a>`` / ``<a>`` per attribute.
    ``events`` is bronze, or silver from ``build_silver``."""
    d = events if "changes" in events.columns else decoded(events)
    d = d.filter(c("entity_name") == entity)
    cols = []
    for a in attributes:
        cols += [F.map_contains_key("changes", a).alias(f"has_{a}"), c("changes")[a].alias(a)]
    return d.select("primary_key", "event_time", "event_id", "arrival_seq", "operation", *cols)


def scratch_dir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/starloom-cdc/{uuid.uuid4().hex}/{name}"


def run_cdc_batches(
    spark: SparkSession,
    landing_dir: str,
    checkpoint_dir: str,
    apply_batch: Callable[[DataFrame, int], None],
    max_files_per_trigger: int | None = None,
) -> None:
    """availableNow stream whose micro-batches go to ``apply_batch(df, id)``.
    ``apply_batch`` must be idempotent per batch id (a failed batch is
    replayed with the same id)."""
    q = (
        to_bronze(read_landing_stream(spark, landing_dir, max_files_per_trigger))
        .writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
