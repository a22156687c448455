"""Job configuration from the environment, and the Spark session it needs."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Where the feed and its store are by default.
DEFAULT_BROKERS = "kafka-1:9092,kafka-2:9092,kafka-3:9092"
DEFAULT_TOPIC = "real-estate-listings"
DEFAULT_BUCKET = "real-estate-data"


# Admission of the rate-limited profile.  A feed faster than the limit
# over a landing interval falls behind, and offsets that expire meanwhile are skipped.
LIMITED_OFFSETS = 10_000


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def _flag(text: str | None, default: bool) -> bool:
    if not text:
        return default
    if text.lower() not in ("true", "false"):
        raise ValueError(f"true or false, not {text!r}")
    return text.lower() == "true"


@dataclass(frozen=True)
class Settings:
    """Where the feed comes from and where its results go.

    There are no default secrets: without explicit keys the object store client
    uses its own credential chain.  By default no message is skipped: a trigger takes
    all offsets there are, and offsets that have expired stop the job.
    ``limited`` gives the profile that trades that for small, steady batches.
    ``state_partitions`` is the number of the summary's state partitions, fixed in
    its checkpoint by the first start; without it, the session's shuffle partitions.
    ``landing_files`` is the most files a landed batch is written to; without it, as
    many as the batch has tasks.  Progress is written every ``progress_every`` batches of a query.
    ``checkpoints`` is by default a folder of the base path.  With ``one_scan`` landing and
    summary are one query.
    """

    brokers: str = DEFAULT_BROKERS
    topic: str = DEFAULT_TOPIC
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    fail_on_data_loss: bool = True
    base_path: str = f"s3a://{DEFAULT_BUCKET}"
    s3_endpoint: str | None = None
    s3_access_key: str | None = None
    s3_secret_key: str | None = None
    landing_interval: str | None = "5 minutes"
    analytics_interval: str | None = "1 minute"
    analytics_mode: str = "update"
    state_partitions: int | None = None
    landing_files: int | None = None
    progress_every: int = 16
    checkpoints: str | None = None
    one_scan: bool = False
    console_rows: int | None = None

    @classmethod
    def limited(cls, **changes) -> "Settings":
        """At most ``LIMITED_OFFSETS`` a trigger, and expired offsets are passed over."""
        given = {
            "max_offsets_per_trigger": LIMITED_OFFSETS,
            "fail_on_data_loss": False,
            "analytics_mode": "complete",
        }
        return cls(**{**given, **changes})

    @property
    def landing_path(self) -> str:
        return f"{self.base_path}/data"

    @property
    def summary_path(self) -> str:
        return f"{self.base_path}/summary"

    @property
    def progress_path(self) -> str:
        return f"{self.base_path}/progress"

    @property
    def checkpoint_root(self) -> str:
        return self.checkpoints or f"{self.base_path}/checkpoints"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> "Settings":
        env = os.environ if env is None else env
        return cls(
            brokers=env.get("KAFKA_BROKERS", DEFAULT_BROKERS),
            topic=env.get("TOPIC_NAME", DEFAULT_TOPIC),
            starting_offsets=env.get("STARTING_OFFSETS", "latest"),
            max_offsets_per_trigger=_number(env.get("MAX_OFFSETS_PER_TRIGGER")),
            min_partitions=_number(env.get("MIN_PARTITIONS")),
            fail_on_data_loss=_flag(env.get("FAIL_ON_DATA_LOSS"), True),
            base_path=env.get("BASE_PATH")
            or f"s3a://{env.get('S3_BUCKET', DEFAULT_BUCKET)}",
            s3_endpoint=env.get("S3_ENDPOINT"),
            s3_access_key=env.get("S3_ACCESS_KEY"),
            s3_secret_key=env.get("S3_SECRET_KEY"),
            landing_interval=env.get("LANDING_INTERVAL", "5 minutes"),
            analytics_interval=env.get("ANALYTICS_INTERVAL", "1 minute"),
            analytics_mode=env.get("ANALYTICS_MODE", "update"),
            state_partitions=_number(env.get("STATE_PARTITIONS")),
            landing_files=_number(env.get("LANDING_FILES")),
            one_scan=_flag(env.get("ONE_SCAN"), False),
            checkpoints=env.get("CHECKPOINTS"),
            progress_every=_number(env.get("PROGRESS_EVERY")) or cls.progress_every,
            console_rows=_number(env.get("CONSOLE_ROWS")),
        )


def object_store_conf(settings: Settings) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` entries; empty for paths on other stores."""
    if not settings.base_path.startswith("s3a://"):
        return {}
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }
    if settings.s3_endpoint:
        secure = settings.s3_endpoint.startswith("https://")
        conf["spark.hadoop.fs.s3a.endpoint"] = settings.s3_endpoint
        conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(secure).lower()
    if settings.s3_access_key and settings.s3_secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = settings.s3_access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = settings.s3_secret_key
    return conf


# Settable on a running session.  The zone is part of the results.  Records are
# wide: fused into one method they outgrow the 8000 bytes of bytecode up to which
# the JVM compiles a method, and run interpreted; past the limit set here Spark
# generates small methods instead.  A task that writes into a few folders keeps them all open; only
# beyond that number does it sort its rows by folder first, which for wide rows spills.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}

# The whole of it, with the state backend; executor counts, memory and shuffle
# partitions belong to spark-submit.
SESSION_CONF = {
    **RUNTIME_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tuned(spark: SparkSession, **changes: str) -> SparkSession:
    """A sibling session with the caller's settings and ``RUNTIME_CONF``; the caller's
    own stays as it is."""
    sibling = spark.newSession()
    given = {row["key"]: row["value"] for row in spark.sql("SET").collect()}
    for name, value in {**given, **RUNTIME_CONF, **changes}.items():
        if sibling.conf.isModifiable(name):
            sibling.conf.set(name, value)
    return sibling


def build_session(
    settings: Settings,
    app_name: str = "listing-stream",
    sizing: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    conf = {**SESSION_CONF, **object_store_conf(settings), **(sizing or {})}
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
