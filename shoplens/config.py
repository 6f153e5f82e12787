"""Job configuration: thresholds, time-of-day buckets, source/target names.

Every knob is an explicit, frozen value. The ``from_env`` constructors name the
environment variables they read; the batch job, the publisher and the loader
each have one.
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass, field


# Fixed values that decide answers (business rules of the feature matrix).
# High spender: 7-day sum >= 1000. Low-cost buyer: 30-day average <= 200.
# Morning: 6 <= hour < 12. Night: hour >= 20 or hour < 6 (night ends where
# morning starts). Shares: delivery/weekend/weekday/morning/night > 0.5,
# cash/card > 0.7. Store loyalty: top-store share >= 0.7. Switching: >= 2
# distinct stores in 30 days. Recurrent: >= 2 purchases. New: registered
# within 30 days.
@dataclass(frozen=True)
class Thresholds:
    high_spender_7d: float = 1000.0
    low_avg_check_30d: float = 200.0
    morning_start: int = 6
    morning_end: int = 12
    night_start: int = 20
    share_half: float = 0.5
    share_payment: float = 0.7
    store_loyal_share: float = 0.7
    switching_stores: int = 2
    recurrent_purchases: int = 2
    new_customer_days: int = 30
    # Parity default: a customer with no 30-day purchase has its NULL
    # average filled with 0.0 and is therefore a "low cost buyer".
    # True restricts the flag to customers with a 30-day purchase.
    low_cost_requires_purchase: bool = False

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> "Thresholds":
        e = os.environ if env is None else env
        return cls(
            high_spender_7d=float(e.get("HIGH_SPENDER_7D", "1000")),
            low_avg_check_30d=float(e.get("LOW_AVG_CHECK_30D", "200")),
            morning_start=int(e.get("MORNING_START", "6")),
            morning_end=int(e.get("MORNING_END", "12")),
            night_start=int(e.get("NIGHT_START", "20")),
        )


@dataclass(frozen=True)
class JobConfig:
    """Where the feature job reads and writes."""

    src_db: str = "retail_mart"
    src_customers: str = "customers_mart"
    src_purchases: str = "purchases_mart"
    tgt_db: str = "retail_analytics"
    tgt_table: str = "customer_feature_matrix"
    truncate_before_load: bool = False
    source_format: str = "parquet"
    source_root: str | None = None
    target_root: str | None = None
    thresholds: Thresholds = field(default_factory=Thresholds)
    as_of: str | None = None
    run_id: str | None = None  # of the load; a load repeated under it is not added twice
    # source_format "jdbc": the warehouse with the marts
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    jdbc_driver: str | None = None
    jdbc_partitions: int = 0  # range queries per table; 0: one
    # per table: column and bounds of the range queries, "column,lower,upper"
    jdbc_customers_range: str | None = None
    jdbc_purchases_range: str | None = None
    # CSV export of the matrix, if a folder is given
    csv_root: str | None = None
    csv_single_file: bool = True

    @property
    def target(self) -> str:
        return f"{self.tgt_db}.{self.tgt_table}"

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> "JobConfig":
        e = os.environ if env is None else env
        return cls(
            src_db=e.get("SRC_DB", "retail_mart"),
            src_customers=e.get("SRC_CUSTOMERS", "customers_mart"),
            src_purchases=e.get("SRC_PURCHASES", "purchases_mart"),
            tgt_db=e.get("TGT_DB", "retail_analytics"),
            tgt_table=e.get("TGT_TABLE", "customer_feature_matrix"),
            truncate_before_load=e.get("TRUNCATE_BEFORE_LOAD", "0") == "1",
            source_format=e.get("SOURCE_FORMAT", "parquet"),
            source_root=e.get("SOURCE_ROOT"),
            target_root=e.get("TARGET_ROOT"),
            jdbc_url=e.get("JDBC_URL") or _warehouse_url(e),
            jdbc_user=e.get("JDBC_USER", e.get("CH_USER")),
            jdbc_password=e.get("JDBC_PASSWORD", e.get("CH_PASS")),
            jdbc_driver=e.get("JDBC_DRIVER"),
            jdbc_partitions=int(e.get("JDBC_PARTITIONS", "0")),
            jdbc_customers_range=e.get("JDBC_CUSTOMERS_RANGE"),
            jdbc_purchases_range=e.get("JDBC_PURCHASES_RANGE"),
            csv_root=e.get("CSV_ROOT"),
            csv_single_file=e.get("CSV_SINGLE_FILE", "1") == "1",
            thresholds=Thresholds.from_env(e),
            as_of=e.get("AS_OF"),
            run_id=e.get("RUN_ID"),
        )


def _warehouse_url(e) -> str | None:
    """The warehouse's URL from its host and port, where these are set."""
    if "CH_HOST" not in e:
        return None
    return f"jdbc:clickhouse://{e['CH_HOST']}:{e.get('CH_PORT', '8123')}/{e.get('SRC_DB', 'retail_mart')}"


@dataclass(frozen=True)
class PublishConfig:
    """What the publisher reads, how it hides personal data, where it writes."""

    source_root: str
    salt: str
    algorithm: str = "hmac_sha256"
    sink_format: str = "kafka"
    bootstrap: str | None = None
    path: str | None = None

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> "PublishConfig":
        e = os.environ if env is None else env
        for name in ("SOURCE_ROOT", "PII_SALT"):
            if not e.get(name):
                raise ValueError(f"{name} is required")
        return cls(source_root=e["SOURCE_ROOT"], salt=e["PII_SALT"], algorithm=e.get("PII_ALGO", "hmac_sha256"),
                   sink_format=e.get("SINK_FORMAT", "kafka"), bootstrap=e.get("KAFKA_BOOTSTRAP"), path=e.get("SINK_PATH"))


@dataclass(frozen=True)
class LoaderConfig:
    input_dir: str
    target_root: str
    mode: str = "upsert"
    drop: bool = False

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> "LoaderConfig":
        e = os.environ if env is None else env
        for name in ("INPUT_DIR", "TARGET_ROOT"):
            if not e.get(name):
                raise ValueError(f"{name} is required")
        return cls(input_dir=e["INPUT_DIR"], target_root=e["TARGET_ROOT"], mode=e.get("LOAD_MODE", "upsert"),
                   drop=e.get("DROP_BEFORE_LOAD", "0") == "1")


def as_of_text(as_of: str | _dt.datetime | _dt.date | None) -> str | None:
    """Normalise an ``as_of`` value to 'yyyy-MM-dd HH:mm:ss' (UTC wall clock)."""
    if as_of is None:
        return None
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return as_of.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(as_of, _dt.date):
        return as_of.strftime("%Y-%m-%d 00:00:00")
    return str(as_of).replace("T", " ").rstrip("Z")
