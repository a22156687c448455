"""The registered queries: (spark, sf_dir) to a flat DataFrame each."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelflow.functions import arrays, pricing, shape, times
from parcelflow.operators import quality, routing
from parcelflow.operators.decode import DAMAGED, decode, decode_fields
from parcelflow.operators.encode import encode
from parcelflow.operators.late import LATE, summary_with_late_rows
from parcelflow.operators.lookup import city_lookup, type_lookup
from parcelflow.operators.exact import finished_means, partial_means
from parcelflow.operators.faults import DEAD
from parcelflow.operators.summary import (
    LISTING_KEYS,
    PARTIAL_KEYS,
    PARTIALS,
    SUMMARY,
    finished_summary,
    flat_window,
    listing_partials,
    listing_summary,
    windowed_summary,
)
from parcelflow.operators.unique import first_of_each, with_repeats
from parcelflow.operators.timecols import (
    EVENT_TIME,
    PROCESSING_TIME,
    stamp_processing_time,
    split_by_trust,
    stamp_record_time,
    watermarked,
)
from parcelflow.plans import listings as fixture
from parcelflow.plans.replay import EVENTS, event_cuts, replay, timed_events
from parcelflow.schema import DAY_KEYS, ENVELOPE, LANDED, LANDED_KEYS, LANDED_MESSAGES
from parcelflow.sinks import files, manifest
from parcelflow.sinks.compaction import compact_days
from parcelflow.sinks.landing import BatchSink, landing_sink
from parcelflow.sinks.messages import store
from parcelflow.sinks.outbox import STORED, outbox_sink, read_once
from parcelflow.settings import SESSION_CONF, Settings, tuned
from parcelflow.sinks.tables import (
    add_batch,
    compact,
    published_table,
    replace_table,
    result_epochs,
    split_sink,
    store_split,
    stored_rows,
    upsert,
    upserted,
)
from parcelflow.sources.landed import landed_table
from parcelflow.sources.messages import file_messages, file_stream
from parcelflow.sources.tables import table
from parcelflow.streaming import job
from parcelflow.streaming.progress import progress_log, watch
from parcelflow.streaming.routed import evenly_keyed
from parcelflow.streaming.runner import await_any, run_to_end, start_to_sink
from parcelflow.workspace import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

# The envelope's time, kept beside the record so damaged rows stay countable.
MESSAGE_TIME = "message_timestamp"
LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
# The least number of stored files that a replay takes in one batch, and the most batches of a replay.
FILES_A_TRIGGER = 2
BATCHES = 6


def _message_time() -> Column:
    return F.col("timestamp").alias(MESSAGE_TIME)


def _rows() -> Column:
    return F.count(F.lit(1)).alias("row_count")


def _exact_sum(column: str, name: str) -> Column:
    """Prices have two decimals, so their decimal sum is exact in any order."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double").alias(name)


def _stored_files(spark: SparkSession, path: str) -> int:
    return sum(name.endswith(".parquet") for name in files.names(spark, path))


def _replayed(spark: SparkSession, path: str, schema: str = ENVELOPE) -> DataFrame:
    """The stored files as a stream in at most ``BATCHES`` batches, so that a larger feed has larger ones
    that keep all tasks busy, not more of them."""
    return file_stream(spark, path, schema, max(FILES_A_TRIGGER, -(-_stored_files(spark, path) // BATCHES)))


def _store_parts(spark: SparkSession, sf_dir: str, path: str, parts: int, **kind: bool) -> None:
    """The listing messages in at least ``parts`` files.  The lines are parted before they are joined and
    encoded: to part whole messages would move every one of them."""
    sent = fixture.messages(spark, sf_dir, mapped=True, keep=["l_orderkey"], **kind)
    key = F.coalesce("l_orderkey", F.lit(0))  # lines without one are of the first part
    for part in range(parts):
        store(sent.filter(F.pmod(key, F.lit(parts)) == part).drop("l_orderkey"), path)


# Decode ------------------------------------------------------------------------


def listing_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = decode(fixture.messages(spark, sf_dir, mapped=True))
    plain = [
        "address.*", "property_details.*", "financials.*", "listing_details.*", "location.*",
    ]
    flat = records.select(
        "property_id",
        *plain,
        F.col("agent.id").alias("agent_id"),
        F.col("agent.name").alias("agent_name"),
        F.col("agent.company").alias("agent_company"),
        F.col("timestamp").alias("record_time"),
    )
    return flat.withColumns(
        {
            "amenities": F.array_join("amenities", "|"),
            "living_area": F.col("living_area").cast("double"),
        }
    )


def listing_decode_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each kind of damage, and of each kind of extreme value."""
    records = decode(
        fixture.messages(spark, sf_dir, damaged=True, extreme=True),
        keep=[F.least("_fault", F.lit(fixture.SOUND)).alias("fault")],
        damaged_column=DAMAGED,
    )
    price, unit_price = F.col("financials.price"), F.col("financials.price_per_sqft")
    return records.groupBy("fault").agg(
        _rows(),
        F.count("property_id").alias("ids"),
        F.count("address.city").alias("cities"),
        F.count("property_details.bedrooms").alias("bedrooms"),
        F.count("property_details.bathrooms").alias("bathrooms"),
        F.count("financials.price").alias("prices"),
        F.count(DAMAGED).alias("damaged_texts"),
        F.count_if(F.isnan(price)).alias("nan_prices"),
        F.count_if(~F.isnan(price) & (price > 1e100)).alias("vast_prices"),
        F.count_if(unit_price == float("-inf")).alias("infinite_unit_prices"),
        F.min("property_details.year_built").cast("double").alias("first_year"),
        F.max("location.walk_score").cast("double").alias("top_walk_score"),
        F.max("financials.tax_assessment").alias("top_tax"),
    )


def message_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per key and partition: messages, and nulls that were written out."""
    sent = fixture.messages(spark, sf_dir, mapped=True)
    body = F.col("value").cast("string")
    return sent.groupBy(F.col("key").cast("string").alias("key"), "topic", "partition").agg(
        _rows(),
        F.count_if(body.contains('"hoa_fee":null')).alias("null_hoa_fees"),
        F.count_if(body.contains('"lot_size":null')).alias("null_lot_sizes"),
        F.sum(F.get_json_object(body, "$.listing_details.days_on_market").cast("bigint"))
        .alias("days_on_market"),
    )


# Windowed summaries --------------------------------------------------------------


def _listing_rows(sent: DataFrame) -> DataFrame:
    rows = decode_fields(sent, keep=[_message_time()])
    return stamp_record_time(rows, fallback=MESSAGE_TIME)


def listing_window_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to 15-minute window x city x type: the flagship."""
    sent = fixture.messages(spark, sf_dir)
    return flat_window(listing_summary(_listing_rows(sent), EVENT_TIME))


def listing_window_summary_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a feed with damaged messages, which form null groups, and with prices that
    are vast, infinite or no numbers, which change the means of their own groups alone."""
    sent = fixture.messages(spark, sf_dir, damaged=True, extreme=True)
    return flat_window(listing_summary(_listing_rows(sent), EVENT_TIME))


# A price times this, and times its inverse, is near either end of the doubles.
FAR = 2.0**996


def exact_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every line its price times ``FAR``, the same below zero, and its price over ``FAR``: the
    first two cancel, so the mean is that of the last, 1e-300 and the like.  In some groups a value is no number."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.pmod("l_orderkey", F.lit(211)).alias("group"),
        "l_linenumber",
        F.explode(F.array(F.lit(FAR), F.lit(-FAR), F.lit(1 / FAR))).alias("factor"),
        F.col("l_extendedprice").alias("price"),
    )
    odd = F.when(F.abs("factor") < 1, F.when(F.col("l_linenumber") == 1, F.col("group")))
    value = (
        F.when(odd == 7, float("nan")).when(odd == 8, float("inf")).when(odd == 9, float("-inf"))
        .when(F.col("group") == 10, None).otherwise(F.col("price") * F.col("factor"))
    )
    counts = {"row_count": F.count(F.lit(1))}
    partials = partial_means(rows.withColumn("value", value), [F.col("group")], {"mean": "value"}, counts)
    found = finished_means(partials, ["group"], ["mean"], ["row_count"])
    number = ~F.isnan("mean") & (F.abs("mean") != float("inf"))
    return found.select(
        "group", "row_count", F.when(number, F.col("mean")).alias("mean"),
        F.when(~number, F.col("mean").cast("string")).alias("no_number"),
    )


def _event_measures() -> list[Column]:
    """Event values have cents, whose double sum hangs on the order of the rows;
    the exact sum over the count is the same mean in any order."""
    mean = F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count("value")
    return [F.count(F.lit(1)).alias("event_count"), mean.alias("avg_value")]


def _event_summary(events: DataFrame) -> DataFrame:
    return windowed_summary(events, "ts", {"event_type": "event_type"}, _event_measures())


def events_window_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k INT").getField("k")
    events = timed_events(spark, sf_dir).select("ts", "event_type", "value", props.alias("k"))
    measures = [*_event_measures(), F.avg("k").alias("avg_k")]
    return flat_window(windowed_summary(events, "ts", {"event_type": "event_type"}, measures))


def processing_time_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clock varies, so what it must not change: over all windows each city and
    type keeps its rows and its mean prices."""
    rows = stamp_processing_time(decode_fields(fixture.messages(spark, sf_dir)))
    return _over_windows(flat_window(listing_summary(rows, PROCESSING_TIME)))


# Streams ---------------------------------------------------------------------------


def stream_complete_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship as a stream in complete mode; the last result table."""
    home = fresh_dir(spark, "stream-complete")
    store(fixture.messages(spark, sf_dir), f"{home}/in")
    feed = _replayed(spark, f"{home}/in")
    partials = flat_window(
        listing_partials(watermarked(_listing_rows(feed), EVENT_TIME), EVENT_TIME)
    )
    sink = replace_table(f"{home}/out", finished_summary)
    run_to_end(
        start_to_sink(partials, sink, "complete", f"{home}/checkpoint", "complete")
    )
    return published_table(spark, f"{home}/out", SUMMARY)


def _summarise_events(events: DataFrame) -> DataFrame:
    return flat_window(_event_summary(watermarked(events, "ts")))


def _replayed_event_summary(
    spark: SparkSession, home: str, cuts: list[DataFrame], mode: str
) -> DataFrame:
    """Every emission of the windowed event summary, with its ``batch_id``."""

    def start() -> StreamingQuery:
        summary = _summarise_events(file_stream(spark, f"{home}/in", EVENTS))
        return start_to_sink(summary, add_batch(f"{home}/out"), mode, f"{home}/checkpoint", mode)

    replay(cuts, f"{home}/in", start)
    return stored_rows(spark, f"{home}/out", _summarise_events(cuts[0]).schema)


def stream_append_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode gives a window once, when the watermark has passed its end."""
    home = fresh_dir(spark, "stream-append")
    cuts = event_cuts(spark, sf_dir)
    return _replayed_event_summary(spark, home, cuts, "append").drop("batch_id")


def stream_update_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode gives changed groups again; the newest of each is the result.  The
    log of emissions is folded after the second cut."""
    home = fresh_dir(spark, "stream-update")
    cuts = event_cuts(spark, sf_dir)
    keys = ["window_start", "window_end", "event_type"]
    schema = _summarise_events(cuts[0]).schema

    def start() -> StreamingQuery:
        summary = _summarise_events(file_stream(spark, f"{home}/in", EVENTS))
        sink = upsert(f"{home}/out")
        return start_to_sink(summary, sink, "update", f"{home}/checkpoint", "update")

    done = replay(cuts[:2], f"{home}/in", start)
    compact(spark, f"{home}/out", keys, schema, done[-1].lastProgress.batchId)
    replay(cuts[2:], f"{home}/in", start)
    return upserted(spark, f"{home}/out", keys, schema)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 20th event arrives one cut late.  In append mode it counts only if its
    window was still open at the watermark the earlier cuts had reached."""
    home = fresh_dir(spark, "stream-late")
    cuts = _late_cuts(spark, sf_dir)
    return _replayed_event_summary(spark, home, cuts, "append").drop("batch_id")


def stream_late_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed, its late rows handed on: windows closed and late rows, each with their events, so
    that what is closed, late or still open is all there is."""
    home = fresh_dir(spark, "stream-late-side")
    rocks = tuned(spark, **{name: value for name, value in SESSION_CONF.items() if ".stateStore." in name})
    cuts = _late_cuts(spark, sf_dir)
    carried = ["event_id", "ts", "value"]
    apart = F.col(LATE).isNotNull().alias("is_late")

    def start() -> StreamingQuery:
        rows = watermarked(file_stream(rocks, f"{home}/in", EVENTS), "ts")
        found = summary_with_late_rows(rows, "ts", ["event_type"], "value", carried, "15 minutes")
        sink = add_batch(f"{home}/out", by=["is_late"])
        return start_to_sink(found.select("*", apart), sink, "late", f"{home}/checkpoint")

    replay(cuts, f"{home}/in", start)
    schema = (
        "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, event_type STRING, row_count BIGINT, mean DOUBLE, "
        "late STRUCT<event_id: BIGINT, ts: TIMESTAMP, value: DOUBLE>, is_late BOOLEAN"
    )
    found = published_table(spark, f"{home}/out", schema)
    kept = ["window_start", "window_end", "event_type", "is_late"]
    closed = found.filter("NOT is_late").select(*kept, "row_count", "mean", F.lit(None).cast("bigint").alias("events"))
    late = found.filter("is_late").groupBy(*kept).agg(
        _rows(), _exact_sum("late.value", "mean"), F.sum("late.event_id").alias("events")
    )
    return closed.unionByName(late).withColumn("events", F.coalesce("events", F.lit(-1)))


def _late_cuts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    held = F.pmod("event_id", F.lit(20)) == 0
    pieces = event_cuts(spark, sf_dir)
    prompt = [piece.filter(~held) for piece in pieces]
    late = [piece.filter(held) for piece in pieces]
    return [prompt[0], prompt[1].union(late[0]), prompt[2].union(late[1]).union(late[2])]


def _listing_feed(
    spark: SparkSession, sf_dir: str, home: str, damaged: bool = False
) -> DataFrame:
    """The listing messages as a stream."""
    store(fixture.messages(spark, sf_dir, mapped=True, damaged=damaged), f"{home}/in")
    return _replayed(spark, f"{home}/in")


def stream_processing_time_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's summary in complete mode over a feed with damaged messages.  Its
    windows follow the clock; over all of them each group keeps its rows."""
    home = fresh_dir(spark, "stream-processing-time")
    partials = job.analytics_rows(_listing_feed(spark, sf_dir, home, damaged=True))
    sink = replace_table(f"{home}/out", finished_summary)
    run_to_end(
        start_to_sink(partials, sink, job.ANALYTICS, f"{home}/checkpoint", "complete")
    )
    return _over_windows(published_table(spark, f"{home}/out", SUMMARY))


def _over_windows(summary: DataFrame) -> DataFrame:
    """Rows of each group and their mean prices times their number, whatever windows
    the clock gave; a mean of cents times its number is whole cents again."""

    def total(column: str, name: str) -> Column:
        cents = F.round(F.col(column) * F.col("listing_count"), 2).cast("decimal(18,2)")
        return F.sum(cents).cast("double").alias(name)

    return summary.groupBy(*LISTING_KEYS).agg(
        F.sum("listing_count").alias("listing_count"),
        total("avg_price", "sum_price"),
        total("avg_price_per_sqft", "sum_price_per_sqft"),
    )


def _damaged_stream(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Messages sent days after their record time, some damaged and some dated far
    ahead, cut by record time.  Sound rows are summed by window; the others are
    counted apart, on a line without a window."""
    home = fresh_dir(spark, f"stream-damaged-{mode}")
    sent = fixture.messages(spark, sf_dir, mapped=True, damaged=True, delayed=True, extreme=True)
    minute = F.pmod("_order", F.lit(1440))
    thirds = [minute < 480, (minute >= 480) & (minute < 960), minute >= 960]
    cuts = [sent.filter(third).drop("_order", "_fault") for third in thirds]

    def rows(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
        return split_by_trust(decode_fields(feed, keep=[_message_time()]), MESSAGE_TIME)

    def start_sound() -> StreamingQuery:
        trusted, _ = rows(file_stream(spark, f"{home}/in"))
        partials = flat_window(listing_partials(watermarked(trusted, EVENT_TIME), EVENT_TIME))
        sink = upsert(f"{home}/sound", PARTIAL_KEYS)
        return start_to_sink(partials, sink, "sound", f"{home}/checkpoint", mode)

    replay(cuts, f"{home}/in", start_sound)
    feed = file_stream(spark, f"{home}/in")
    _, rest = rows(feed)
    apart = rest.select(EVENT_TIME)
    sink = add_batch(f"{home}/apart")
    run_to_end(start_to_sink(apart, sink, "apart", f"{home}/checkpoint"))
    sound = finished_summary(upserted(spark, f"{home}/sound", PARTIAL_KEYS, PARTIALS))
    stored = published_table(spark, f"{home}/apart", f"{EVENT_TIME} TIMESTAMP")
    nothing = [
        F.lit(None).cast(f.dataType).alias(f.name) if f.name != "listing_count"
        else F.count(F.lit(1)).alias(f.name)
        for f in sound.schema
    ]
    return sound.unionByName(stored.agg(*nothing))


def stream_damaged_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _damaged_stream(spark, sf_dir, "append")


def stream_damaged_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _damaged_stream(spark, sf_dir, "update")


def job_two_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job as it starts its queries, on timed triggers: landed rows and the stored
    summary's rows by city and type, and whether one query's failure stops the other."""
    home = fresh_dir(spark, "job")
    settings = Settings(
        base_path=home, landing_interval="1 second", analytics_interval="1 second"
    )
    feed = _listing_feed(spark, sf_dir, home, damaged=True)
    queries = job.start(feed, settings)
    for query in queries:
        query.processAllAvailable()

    def broken(batch: DataFrame, batch_id: int) -> None:
        raise RuntimeError("no disk")

    failing = start_to_sink(feed, broken, "broken", f"{home}/checkpoints", interval="1 second")
    stopped = False
    try:
        await_any(spark, (*queries, failing))
    except Exception as failure:
        if "no disk" not in str(failure):
            raise
        stopped = not any(query.isActive for query in queries)
    finally:
        spark.streams.resetTerminated()
    landed = landed_table(spark, settings.landing_path).groupBy(
        F.col("address.city").alias("city"), F.col("property_details.type").alias("type")
    ).agg(F.count(F.lit(1)).alias("landed_rows"))
    summed = _over_windows(job.summary_table(spark, settings)).select(
        F.col("city").alias("_city"), F.col("type").alias("_type"), "listing_count", "sum_price"
    )
    same = F.col("city").eqNullSafe(F.col("_city")) & F.col("type").eqNullSafe(F.col("_type"))
    return landed.join(summed, same, "full").select(
        "city", "type", "landed_rows", "listing_count", "sum_price",
        F.lit(stopped).alias("stopped_together"),
    )


MODES = ("update", "complete", "append")


def job_fresh_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job runs over half of the messages, in two batches; then its checkpoints are lost, and it
    starts over with fresh ones on the same tables and all messages.  In every mode the summary is that of
    the new run, and the old one can still be read by its epoch; progress holds both, and so do the
    landed rows of the mode that is run with its landing."""
    found = []
    inputs = fresh_dir(spark, "job-fresh-in")
    sent = fixture.messages(spark, sf_dir, mapped=True, keep=["l_orderkey"])
    stored = {}
    for n in (0, 1):
        for quarter in (n, n + 2):  # two files at least, and no message is moved for it
            store(sent.filter(F.pmod("l_orderkey", F.lit(4)) == quarter).drop("l_orderkey"), f"{inputs}/{n}")
        stored[n] = _stored_files(spark, f"{inputs}/{n}")
    at_once = (-(-stored[0] // 2), sum(stored.values()))
    for mode in MODES:
        home = fresh_dir(spark, f"job-fresh-{mode}")
        for turn, parts in enumerate(("0", "{0,1}")):
            settings = Settings(
                base_path=home, landing_interval=None, analytics_interval=None, analytics_mode=mode,
                checkpoints=f"{home}/checkpoints-{turn}", progress_every=2,
            )
            feed = file_stream(spark, f"{inputs}/{parts}", max_files_per_trigger=at_once[turn])
            log = job.log_progress(spark, settings)
            start = job.start if mode == "update" else job.start_analytics
            for query in start(feed, settings):
                run_to_end(query)
                log.settled(query)
            spark.streams.removeListener(log)
        epochs = [epoch for epoch, _, _ in result_epochs(spark, settings.summary_path)]
        results = [job.summary_table(spark, settings, epoch) for epoch in (None, *epochs[:1])]
        rows = [result.agg(F.coalesce(F.sum("listing_count"), F.lit(0))).first()[0] for result in results]
        lines = progress_log(spark, settings.progress_path)
        read = lines.groupBy("query", "run").agg(F.sum("input_rows").alias("rows")).sort("query", "rows")
        read_rows = ",".join(str(row["rows"]) for row in read.collect())
        found.append((mode, len(epochs), *rows, job.landed(spark, settings).count(), read_rows))
    names = "mode STRING, epochs INT, summed_rows BIGINT, epoch_1_rows BIGINT, landed_rows BIGINT, read STRING"
    return spark.createDataFrame(found, names)


def _two_falls(sink: BatchSink, between: Callable[[DataFrame, int], None]) -> BatchSink:
    """A sink that dies twice: in batch 0 after its first step, in batch 1 after all of them."""
    fallen: set[int] = set()

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0 and batch_id not in fallen:
            between(batch, batch_id)
        else:
            sink(batch, batch_id)
        if batch_id in (0, 1) and batch_id not in fallen:
            fallen.add(batch_id)
            raise RuntimeError("died on purpose")

    return write


def _run_through(start: Callable[[], StreamingQuery], falls: int = 2) -> None:
    """Start a query again after each fall."""
    for _ in range(falls):
        try:
            run_to_end(start())
        except Exception as died:
            if "died on purpose" not in str(died):
                raise
    run_to_end(start())


def job_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing and summary as one query, which dies once between the two writes and once after both, and
    is started again: both tables hold each message once."""
    home = fresh_dir(spark, "job-one-scan")
    settings = Settings(base_path=home, analytics_interval=None, one_scan=True)
    _store_parts(spark, sf_dir, f"{home}/in", 2 * FILES_A_TRIGGER, damaged=True)
    feed = _replayed(spark, f"{home}/in")
    landing = landing_sink(settings.landing_path, apart=[DEAD])
    sink = _two_falls(job.shared_sink(settings), landing)
    _run_through(lambda: start_to_sink(job.landing_rows(feed), sink, job.SHARED, settings.checkpoint_root))
    landed = job.landed(spark, settings).groupBy(
        F.col("address.city").alias("city"), F.col("property_details.type").alias("type")
    ).agg(F.count(F.lit(1)).alias("landed_rows"))
    summed = _over_windows(job.shared_summary(spark, settings)).withColumnsRenamed(
        {"city": "_city", "type": "_type"}
    )
    same = F.col("city").eqNullSafe(F.col("_city")) & F.col("type").eqNullSafe(F.col("_type"))
    return landed.join(summed, same, "full").drop("_city", "_type")


def stream_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that turns hot half-way: in the first two of four batches no city has much, in the others
    most rows are of one.  From then on its rows are divided, and no key that routes has an even share."""
    home = fresh_dir(spark, "stream-routed")
    turn = F.pmod("l_orderkey", F.lit(4))
    rushed = (turn >= 2) & (F.pmod("l_partkey", F.lit(3)) != 0)
    rows = _flat(spark, sf_dir).select(
        "property_id", F.when(rushed, F.lit("Phoenix")).otherwise(F.col("city")).alias("city"), turn.alias("turn")
    )

    sink = evenly_keyed(add_batch(f"{home}/out"), f"{home}/keys", 6, "city", "property_id")
    schema = "property_id STRING, city STRING, turn BIGINT"

    def start() -> StreamingQuery:
        return start_to_sink(file_stream(spark, f"{home}/in", schema), sink, "routed", f"{home}/checkpoint")

    replay([rows.filter(F.col("turn") == n) for n in range(4)], f"{home}/in", start)
    found = stored_rows(spark, f"{home}/out", f"{schema}, _even_key STRING")
    hot = F.col("city") == "Phoenix"
    loads = found.groupBy("batch_id", "_even_key").agg(_rows())
    worst = loads.groupBy(F.col("batch_id").alias("_batch")).agg(
        (F.max("row_count") * 6 < F.sum("row_count")).alias("even")
    )
    return found.groupBy("batch_id").agg(
        _rows(),
        F.count_if(hot).alias("phoenix_rows"),
        (F.count_distinct(F.when(hot, F.col("_even_key"))) > 1).alias("divided"),
    ).join(worst, F.col("batch_id") == F.col("_batch")).select(
        "batch_id", "row_count", "phoenix_rows", "divided", "even"
    )


def quality_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings that share their identifier with others."""
    rows = with_repeats(_flat(spark, sf_dir).select("property_id", "price"))
    return rows.filter("repeats IS NOT NULL").groupBy("property_id", "repeats").agg(_exact_sum("price", "sum_price"))


def stream_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of every identifier of a stream, and how many the others are."""
    home = fresh_dir(spark, "stream-unique")
    rows = _listing_rows_with_id(_listing_feed(spark, sf_dir, home))
    unique = first_of_each(rows.withWatermark(EVENT_TIME, "2 days")).select("property_id")
    run_to_end(start_to_sink(unique, add_batch(f"{home}/out"), "unique", f"{home}/checkpoint"))
    first = published_table(spark, f"{home}/out", "property_id STRING")
    sent = file_messages(spark, f"{home}/in").agg(_rows())
    counted = first.agg(F.count(F.lit(1)).alias("first_rows"), F.count_distinct("property_id").alias("ids"))
    return counted.select("first_rows", "ids", (F.lit(sent.first()[0]) - F.col("first_rows")).alias("repeats"))


def _listing_rows_with_id(sent: DataFrame) -> DataFrame:
    rows = decode_fields(sent, ["property_id", "timestamp"], keep=[_message_time()])
    return stamp_record_time(rows, fallback=MESSAGE_TIME)


def messages_sent_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages sent by way of the outbox, by a query that dies once before it sends and once after: some
    go out twice, and each is read once."""
    home = fresh_dir(spark, "outbox")
    _store_parts(spark, sf_dir, f"{home}/in", 2 * FILES_A_TRIGGER)
    feed = _replayed(spark, f"{home}/in", "key BINARY, value BINARY, topic STRING, partition INT")
    fallen: set[int] = set()

    def send(messages: DataFrame) -> None:
        turn = len(fallen)
        if turn == 0:
            fallen.add(turn)
            raise RuntimeError("died on purpose")  # before anything is sent
        store(messages, f"{home}/topic")
        if turn == 1:
            fallen.add(turn)
            raise RuntimeError("died on purpose")  # sent, not marked

    sink = outbox_sink(f"{home}/outbox", send)
    _run_through(lambda: start_to_sink(feed, sink, "outbox", f"{home}/checkpoint"))
    arrived = spark.read.schema(STORED).parquet(f"{home}/topic")
    price = F.get_json_object(F.col("value").cast("string"), "$.financials.price").cast("decimal(18,2)")
    # Each message's price is read before the repeats are dropped, which then moves no message whole.
    once = read_once(arrived.select("key", price.alias("price"), "headers")).groupBy(
        F.col("key").cast("string").alias("key")
    ).agg(_rows(), F.sum("price").cast("double").alias("sum_price"))
    return once.withColumn("sent_again", F.lit(arrived.count() > file_messages(spark, f"{home}/in").count()))


def stream_price_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both lookups joined to a stream, and the estimate from them.  Messages on
    land carry no area, so these have none."""
    home = fresh_dir(spark, "stream-estimate")
    rows = type_lookup(city_lookup(decode(_listing_feed(spark, sf_dir, home))))
    estimate = pricing.price_estimate(
        F.col("property_details.living_area"),
        F.col("type_base_price_per_sqft"),
        F.col("city_price_multiplier"),
        F.col("property_details.bedrooms"),
        times.years_since(F.col("property_details.year_built"), fixture.as_of()),
        F.col("property_details.neighborhood_class"),
    )
    priced = rows.select(
        "property_id",
        F.col("address.city").alias("city"),
        "city_state",
        F.col("property_details.type").alias("type"),
        estimate.alias("price_estimate"),
    )
    run_to_end(
        start_to_sink(priced, add_batch(f"{home}/out"), "estimate", f"{home}/checkpoint")
    )
    return published_table(spark, f"{home}/out", priced.schema)


def stream_quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule check and the split on a stream."""
    home = fresh_dir(spark, "stream-quality")
    store(fixture.messages(spark, sf_dir, ruled=True), f"{home}/in")
    rows = decode(_replayed(spark, f"{home}/in"))
    marked = quality.with_violations(rows, fixture.as_of())
    run_to_end(start_to_sink(marked, split_sink(f"{home}/out"), "split", f"{home}/checkpoint"))
    return _by_side(published_table(spark, f"{home}/out", marked.schema.add("side", "string")))


# Landing -----------------------------------------------------------------------------


def _days(landed: DataFrame, *measures: Column) -> DataFrame:
    return landed.groupBy(*DAY_KEYS).agg(_rows(), *measures)


def _land_events(spark: SparkSession, home: str, sink: BatchSink) -> None:
    """Land the stored events in two batches."""
    feed = _replayed(spark, f"{home}/in", EVENTS)
    run_to_end(start_to_sink(feed, sink, "landing", f"{home}/checkpoint"))


def landing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed by their own day, read back."""
    home = fresh_dir(spark, "landing")
    for cut in event_cuts(spark, sf_dir):
        store(cut, f"{home}/in")
    _land_events(spark, home, landing_sink(f"{home}/data", "ts"))
    landed = landed_table(spark, f"{home}/data", f"{EVENTS}, {LANDED_KEYS}")
    return _days(
        landed,
        _exact_sum("value", "sum_value"),
        F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"),
    )


def landing_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed in several batches, every day then folded: the same rows, in one
    file a day."""
    home = fresh_dir(spark, "landing-compacted")
    for cut in event_cuts(spark, sf_dir):
        store(cut, f"{home}/in")
    _land_events(spark, home, landing_sink(f"{home}/data", "ts"))
    schema = f"{EVENTS}, {LANDED_KEYS}"
    days = landed_table(spark, f"{home}/data", schema).select(*DAY_KEYS).distinct().collect()
    compact_days(spark, f"{home}/data", [date(*found) for found in days], schema)
    landed = landed_table(spark, f"{home}/data", schema)
    files = (
        landed.select(*DAY_KEYS, F.input_file_name().alias("file"))
        .groupBy(*DAY_KEYS)
        .agg(F.count_distinct("file").alias("files"))
    )
    return _days(landed, _exact_sum("value", "sum_value")).join(files, list(DAY_KEYS))


FOLDS = 4


def landing_folded_while_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed in two batches and folded, over and over; each time a batch lands between the
    read and the exchange of a fold, in the same days.  All rows stay, folded batches that are run again
    change nothing, and the scan names no more folders than there are live ones."""
    home = fresh_dir(spark, "landing-folded")
    schema, path = f"{EVENTS}, {LANDED_KEYS}", f"{home}/data"
    events = timed_events(spark, sf_dir)
    days = [date(*row) for row in _event_days(events).collect()]
    piece = F.pmod("event_id", F.lit(2 * FOLDS))
    exchange = manifest.exchange

    def land_piece(n: int) -> None:
        landing_sink(path, "ts", run="feed")(events.filter(piece == n), n)

    def late_exchange(*given) -> bool:
        land_piece(2 * fold + 1)
        return exchange(*given)

    manifest.exchange = late_exchange
    try:
        for fold in range(FOLDS):
            land_piece(2 * fold)
            compact_days(spark, path, days, schema)
            land_piece(2 * fold)  # the batch is run again: its rows are in the fold
    finally:
        manifest.exchange = exchange
    landed = landed_table(spark, path, schema)
    live = len(manifest.live(spark, path))
    return _days(
        landed,
        _exact_sum("value", "sum_value"),
        F.count_distinct("event_id").alias("events"),
        F.count_distinct("batch_id").alias("batches"),
        F.lit(live <= 5 * len(days)).alias("few_folders"),
    )


def _event_days(events: DataFrame) -> DataFrame:
    return events.select(F.year("ts"), F.month("ts"), F.dayofmonth("ts")).distinct()


def landing_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of some hours, read by the times the manifest has of each folder."""
    home = fresh_dir(spark, "landing-times")
    schema, path = f"{EVENTS}, {LANDED_KEYS}", f"{home}/data"
    sink = landing_sink(path, "ts", run="feed")
    for n, cut in enumerate(event_cuts(spark, sf_dir)):
        for half in range(2):
            sink(cut.filter((F.hour("ts") >= 12) == bool(half)), 2 * n + half)
    since, until = (datetime(2024, 1, d, 3, tzinfo=timezone.utc) for d in (9, 12))
    found = landed_table(spark, path, schema, since=since, until=until)
    folders = len(found.select(F.regexp_extract(F.input_file_name(), "(.*)/", 1)).distinct().collect())
    inside = (F.col("ts") >= F.lit(since)) & (F.col("ts") < F.lit(until))
    return _days(found.filter(inside), _exact_sum("value", "sum_value")).withColumn(
        "folders_read", F.lit(folders)
    )


def landing_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's landing over a damaged feed, one of its batches run twice and the day folded: every
    damaged message comes back byte for byte, with its place in the topic and the kind of fault."""
    home = fresh_dir(spark, "landing-dead")
    settings = Settings(base_path=home, landing_interval=None)
    feed = _listing_feed(spark, sf_dir, home, damaged=True)
    land = landing_sink(settings.landing_path, apart=[DEAD])

    def land_twice(batch: DataFrame, batch_id: int) -> None:
        land(batch, batch_id)
        if batch_id == 0:
            land(batch, batch_id)

    run_to_end(start_to_sink(job.landing_rows(feed), land_twice, job.LANDING, f"{home}/checkpoint"))
    _fold_all(spark, settings)
    # The fixture's places in the topic are not unique, so messages are compared as a multiset.
    place = ["topic", "partition", "offset", "key", "bytes"]
    digest = F.coalesce(F.sha2("value", 256), F.lit("none")).alias("bytes")
    sent = file_messages(spark, f"{home}/in").select(*place[:-1], digest)
    dead = job.dead_letter_table(spark, settings).select(*place[:-1], digest, "fault")
    counted = sent.groupBy(*place).agg(F.count(F.lit(1)).alias("sent"))
    found = dead.groupBy(*place, "fault").agg(F.count(F.lit(1)).alias("rows"))
    return found.join(counted, place, "left").groupBy("fault").agg(
        F.sum("rows").alias("row_count"),
        F.sum(F.when(F.col("rows") == F.col("sent"), F.col("rows")).otherwise(0)).alias("as_sent"),
        F.sum(F.when(F.col("bytes") != "none", F.col("rows")).otherwise(0)).alias("with_bytes"),
    )


def _fold_all(spark: SparkSession, settings: Settings) -> None:
    rows = job.landed(spark, settings)
    days = [date(*day) for day in rows.select(*DAY_KEYS).distinct().collect()]
    compact_days(spark, settings.landing_path, days, LANDED_MESSAGES, [DEAD])


def landing_unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a field the schema does not know, at the top or within: their records are whole
    and the fields can be read; all other messages keep nothing beside the record."""
    home = fresh_dir(spark, "landing-unknown")
    settings = Settings(base_path=home, landing_interval=None)
    sent = fixture.messages(spark, sf_dir, mapped=True, keep=["l_orderkey"])
    text, order = F.col("value").cast("string"), F.pmod("l_orderkey", F.lit(5))
    top = F.concat(F.lit('{"grade":'), F.col("offset"), F.lit(","), F.expr("substr(cast(value AS string), 2)"))
    inner = F.regexp_replace(text, '"address":[{]', '"address":{"floor":{"level":3},')
    value = F.when(order == 0, top).when(order == 1, inner).otherwise(text)
    store(sent.withColumn("value", value.cast("binary")).drop("l_orderkey"), f"{home}/in")
    rows = job.landing_rows(file_stream(spark, f"{home}/in"))
    sink = landing_sink(settings.landing_path, apart=[DEAD])
    run_to_end(start_to_sink(rows, sink, job.LANDING, f"{home}/checkpoint"))
    landed = job.landed(spark, settings)
    grade = F.try_variant_get("extra", "$.grade", "bigint")
    level = F.try_variant_get("extra", "$.address.floor.level", "int")
    return landed.groupBy(F.col("property_details.type").alias("type")).agg(
        _rows(),
        F.count("property_id").alias("ids"),
        F.count("extra").alias("with_more"),
        F.count_if(F.col(DEAD)).alias("dead"),
        F.sum(grade).alias("grades"),
        F.sum(level).alias("levels"),
    )


def landing_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, but the job dies after a write and before its commit, and the
    query is started again.  No row may be lost or landed twice."""
    home = fresh_dir(spark, "landing-retry")
    for cut in event_cuts(spark, sf_dir):
        store(cut, f"{home}/in")
    land = landing_sink(f"{home}/data", "ts")

    def land_and_die(batch: DataFrame, batch_id: int) -> None:
        land(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("died after the write")

    try:
        _land_events(spark, home, land_and_die)
    except Exception as died:
        if "died after the write" not in str(died):
            raise
    _land_events(spark, home, land)
    landed = landed_table(spark, f"{home}/data", f"{EVENTS}, {LANDED_KEYS}")
    return _days(landed, _exact_sum("value", "sum_value"))


def landing_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded listings landed by record time; nested columns read back whole."""
    home = fresh_dir(spark, "landing-listings")
    feed = _listing_feed(spark, sf_dir, home)
    records = stamp_record_time(decode(feed, keep=[_message_time()]), fallback=MESSAGE_TIME)
    rows = stamp_processing_time(records.drop(MESSAGE_TIME))
    sink = landing_sink(f"{home}/data", EVENT_TIME)
    run_to_end(start_to_sink(rows, sink, "landing", f"{home}/checkpoint"))
    landed = landed_table(spark, f"{home}/data", f"{LANDED}, {EVENT_TIME} TIMESTAMP")
    return landed.groupBy(
        *DAY_KEYS,
        F.col("address.city").alias("city"),
        F.col("property_details.type").alias("type"),
    ).agg(
        _rows(),
        _exact_sum("financials.price", "sum_price"),
        F.sum(F.size("property_details.amenities")).alias("amenities"),
        F.count("property_details.living_area").alias("living_areas"),
        F.count(PROCESSING_TIME).alias("stamped"),
    )


def landing_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's landing over a feed with damaged messages: all of them land, under
    the day they were processed."""
    home = fresh_dir(spark, "landing-processing-time")
    rows = job.landing_rows(_listing_feed(spark, sf_dir, home, damaged=True))
    sink = landing_sink(f"{home}/data", apart=[DEAD])
    run_to_end(start_to_sink(rows, sink, job.LANDING, f"{home}/checkpoint"))
    landed = landed_table(spark, f"{home}/data", LANDED_MESSAGES)
    stamp = F.to_date(PROCESSING_TIME)
    return landed.groupBy(
        F.col("address.city").alias("city"), F.col("property_details.type").alias("type")
    ).agg(
        _rows(),
        F.count_if(F.make_date("year", "month", "day") == stamp).alias("on_their_day"),
    )


# Lookups and derived columns -----------------------------------------------------------


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.flat_listings(spark, sf_dir, mapped=True)


def city_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the cities are known by the lookup, the nations are not."""
    rows = _flat(spark, sf_dir)
    known = F.pmod("l_orderkey", F.lit(2)) == 0
    rows = rows.withColumn("city", F.when(known, F.col("city")).otherwise(F.col("n_name")))
    return city_lookup(rows.select(*LINE, "city"), "city")


def type_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_lookup(_flat(spark, sf_dir).select(*LINE, "type"), "type")


def price_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = type_lookup(city_lookup(_flat(spark, sf_dir), "city"), "type")
    estimate = pricing.price_estimate(
        F.col("sqft"),
        F.col("type_base_price_per_sqft"),
        F.col("city_price_multiplier"),
        F.col("bedrooms"),
        times.years_since(F.col("year_built"), fixture.as_of()),
        F.col("neighborhood_class"),
    )
    return rows.select(*LINE, estimate.alias("price_estimate"))


def age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = times.years_since(F.col("year_built"), fixture.as_of())
    rows = _flat(spark, sf_dir).select(
        pricing.age_band(age).alias("age_band"),
        pricing.age_factor(age).alias("age_factor"),
        "price",
    )
    return rows.groupBy("age_band", "age_factor").agg(_rows(), _exact_sum("price", "sum_price"))


def unit_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per living area, so land has none."""
    rows = _flat(spark, sf_dir)
    ratio = pricing.unit_price(F.col("price"), F.col("living_area"))
    return rows.select(*LINE, ratio.alias("unit_price"))


def listing_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir).select(*LINE, "description")


def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir).select(
        *LINE, "property_id", "agent_id", "zip_code", "school_district"
    )


def days_on_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _flat(spark, sf_dir)
    days = times.days_on_market(F.col("listing_date"), fixture.as_of())
    return rows.select(*LINE, "listing_date", days.alias("days_on_market"))


def record_time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts to dates and times and back; a cut-off text gives null."""
    rows = _flat(spark, sf_dir)
    odd = F.pmod("l_orderkey", F.lit(2)) == 1
    given = F.when(odd, F.col("timestamp")).otherwise(F.substring("timestamp", 1, 19))
    parsed = times.parse_record_time(given)
    sold = times.parse_date(F.col("last_sale_date"))
    return rows.select(
        *LINE,
        parsed.cast("timestamp_ntz").alias("record_time"),
        times.format_record_time(parsed).alias("record_text"),
        sold.cast("timestamp_ntz").alias("last_sale_day"),
        times.format_date(sold).alias("last_sale_text"),
    )


def amenity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays.name_counts(_flat(spark, sf_dir), "amenities")


def amenity_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.col("amenities")
    pool = F.array(F.lit("Pool"), F.lit("Gym"), F.lit("Parking"), F.lit("Garden"))
    return _flat(spark, sf_dir).select(
        *LINE,
        F.array_join(arrays.first_names(names), ", ").alias("first_three"),
        F.size(names).alias("amenity_count"),
        arrays.is_distinct(names).alias("all_distinct"),
        F.size(F.array_except(names, pool)).alias("beyond_four"),
    )


def land_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("type")
    sqft = F.col("sqft")
    rows = _flat(spark, sf_dir).select(
        "type",
        shape.only_land(kind, sqft * 2).alias("lot_size"),
        shape.only_building(kind, sqft).alias("living_area"),
        shape.zero_on_land(kind, F.col("floors")).alias("floors"),
    )
    return rows.groupBy("type").agg(
        _rows(),
        F.count("lot_size").alias("lots"),
        F.coalesce(F.sum("lot_size"), F.lit(0)).alias("lot_sqft"),
        F.count("living_area").alias("areas"),
        F.coalesce(F.sum("living_area"), F.lit(0)).alias("living_sqft"),
        F.sum("floors").alias("floors"),
    )


# Quality ---------------------------------------------------------------------------

def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.ruled_listings(spark, sf_dir, keep=LINE)


def quality_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violation_counts(_nested(spark, sf_dir), fixture.as_of())


def quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = quality.with_violations(_nested(spark, sf_dir), fixture.as_of())
    broken = F.array_join(quality.VIOLATIONS, ",").alias("violations")
    return marked.select(*LINE, broken)


def quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on either side of a stored split, by type."""
    home = fresh_dir(spark, "quality")
    marked = quality.with_violations(_nested(spark, sf_dir), fixture.as_of())
    store_split(marked, home)
    return _sides(spark, home, marked)


def _sides(spark: SparkSession, path: str, marked: DataFrame) -> DataFrame:
    return _by_side(spark.read.schema(marked.schema.add("side", "string")).parquet(path))


def _by_side(sides: DataFrame) -> DataFrame:
    return sides.groupBy("side", F.col("property_details.type").alias("type")).agg(
        _rows(), _exact_sum("financials.price", "sum_price")
    )


# Routing and progress -----------------------------------------------------------------


def route_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = routing.rows_per_key(_flat(spark, sf_dir), "city")
    return keyed.withColumn("partition", routing.topic_partition(F.col("key"), 6))


def routing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.routing_report(_flat(spark, sf_dir), 6, "city")


def hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the listings are given one city, which then needs dividing."""
    rows = _flat(spark, sf_dir)
    rushed = F.pmod("l_orderkey", F.lit(3)) == 0
    city = F.when(rushed, F.lit("Phoenix")).otherwise(F.col("city"))
    return routing.hot_keys(rows.select(city.alias("city")), 6, "city")


def routed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a hot key, each sent to the partition its key names, stored by
    partition and read back: the rows that really lie in each, and those the
    report foretells."""
    home = fresh_dir(spark, "routed")
    rushed = F.pmod("l_orderkey", F.lit(3)) == 0
    city = F.when(rushed, F.lit("Phoenix")).otherwise(F.col("city"))
    rows = _flat(spark, sf_dir).select("property_id", city.alias("city"))
    keyed = routing.with_even_key(rows, 6, "city", "property_id")
    sent = encode(
        keyed, F.col("city"), fixture.TOPIC, ["property_id", "city"],
        partition=routing.topic_partition(F.col("_even_key"), 6),
    )
    # Several tasks serve a partition, or the rows of each would be one task's, however many they are.
    lanes = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 6)
    lane = F.pmod(F.xxhash64("key", "value"), F.lit(lanes)).cast("int")
    placed = sent.repartitionById(6 * lanes, F.col("partition") + 6 * lane)
    task = F.pmod(F.spark_partition_id(), F.lit(6))
    placed.withColumn("task", task).write.partitionBy("partition").parquet(home)
    stored = spark.read.schema("key BINARY, task INT, partition INT").parquet(home)
    found = stored.groupBy("partition").agg(
        _rows(),
        F.count_if(F.col("key").cast("string") == "Phoenix").alias("hot_rows"),
        F.count_distinct("task").alias("tasks"),
        F.first("task").alias("task"),
    )
    told = routing.routing_report(keyed, 6, "_even_key").select(
        F.col("partition").alias("_partition"), F.col("row_count").alias("reported_rows")
    )
    return found.join(told, F.col("partition") == F.col("_partition"), "full").agg(
        F.sum("row_count").alias("row_count"),
        F.count_if(F.col("row_count") == F.col("reported_rows")).alias("as_reported"),
        F.count_if((F.col("tasks") == 1) & (F.col("task") == F.col("partition"))).alias("in_place"),
        (F.max("hot_rows") * 2 < F.sum("hot_rows")).alias("hot_key_divided"),
    )


def query_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and rows dropped as late, of every batch of a query that is started four times, as its
    listener wrote them."""
    home = fresh_dir(spark, "progress")
    log = watch(spark, f"{home}/progress", every=2)
    cuts = _late_cuts(spark, sf_dir)

    def start() -> StreamingQuery:
        rows = watermarked(file_stream(spark, f"{home}/in", EVENTS), "ts")
        ends = F.window("ts", "15 minutes")
        counted = rows.groupBy(ends, "event_id").agg(_rows()).select("window.end", "event_id", "row_count")
        return start_to_sink(counted, add_batch(f"{home}/out"), "feed", f"{home}/checkpoint")

    try:
        for query in replay(cuts, f"{home}/in", start):
            log.settled(query)
    finally:
        spark.streams.removeListener(log)
    lines = progress_log(spark, f"{home}/progress")
    return lines.filter("input_rows > 0").select(
        "query",
        (F.row_number().over(Window.orderBy("batch_id")) - 1).alias("turn"),
        "input_rows",
        "late_rows",
        (F.col("rows_per_second") > 0).alias("has_rate"),
        F.col("watermark").isNotNull().alias("has_watermark"),
    )


QUERIES: dict[str, Query] = {
    "listing_decode": listing_decode,
    "listing_decode_malformed": listing_decode_malformed,
    "message_envelope": message_envelope,
    "listing_window_summary": listing_window_summary,
    "listing_window_summary_malformed": listing_window_summary_malformed,
    "events_window_summary": events_window_summary,
    "processing_time_summary": processing_time_summary,
    "exact_means": exact_means,
    "stream_complete_equals_batch": stream_complete_equals_batch,
    "stream_append_closed_windows": stream_append_closed_windows,
    "stream_update_upsert": stream_update_upsert,
    "stream_late_rows": stream_late_rows,
    "stream_late_side": stream_late_side,
    "stream_processing_time_summary": stream_processing_time_summary,
    "stream_damaged_append": stream_damaged_append,
    "stream_damaged_update": stream_damaged_update,
    "job_two_queries": job_two_queries,
    "job_fresh_checkpoint": job_fresh_checkpoint,
    "job_one_scan": job_one_scan,
    "stream_routed": stream_routed,
    "stream_unique": stream_unique,
    "quality_repeats": quality_repeats,
    "messages_sent_once": messages_sent_once,
    "stream_price_estimate": stream_price_estimate,
    "stream_quality_split": stream_quality_split,
    "landing_partitions": landing_partitions,
    "landing_compacted": landing_compacted,
    "landing_folded_while_landing": landing_folded_while_landing,
    "landing_by_time": landing_by_time,
    "landing_dead_letters": landing_dead_letters,
    "landing_unknown_fields": landing_unknown_fields,
    "landing_retry": landing_retry,
    "landing_listings": landing_listings,
    "landing_processing_time": landing_processing_time,
    "city_lookup": city_lookup_query,
    "type_lookup": type_lookup_query,
    "price_estimate": price_estimate,
    "age_band": age_band,
    "unit_price": unit_price,
    "listing_description": listing_description,
    "identifiers": identifiers,
    "days_on_market": days_on_market,
    "record_time_parse": record_time_parse,
    "amenity_counts": amenity_counts,
    "amenity_lists": amenity_lists,
    "land_shape": land_shape,
    "quality_violations": quality_violations,
    "quality_rows": quality_rows,
    "quality_split": quality_split,
    "route_by_key": route_by_key,
    "routing_report": routing_report,
    "hot_keys": hot_keys,
    "routed_messages": routed_messages,
    "query_progress": query_progress,
}
