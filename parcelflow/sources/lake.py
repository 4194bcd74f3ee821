"""A layered table store in which a run becomes visible as a whole or not at all.

Tables are written under ``run=<id>/<layer>/<table>``. Readers look up the last entry
of the publish log; a run that fails before it is published leaves the previous run
in place. The log has one file for each sequence number, which only one publisher can
create; a publisher that comes second takes the next number.

Staging and curated tables with an order id are stored in buckets of it, as many for all tables
of a run, so joins and groupings by order read them in place without a shuffle.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.schemas import CURATED, STAGING
from parcelflow.sources.commits import delete_folder, put_if_absent, records

RAW, STAGING_LAYER, CURATED_LAYER = "raw", "staging", "curated"
BUCKET_KEY = "order_id"
_LAYOUT_SCHEMA = "run_id string, buckets int"
_LOG_SCHEMA = "sequence bigint, run_id string, published_at string"


def _schema(layer: str, table: str) -> T.StructType:
    if layer == CURATED_LAYER:
        return CURATED[table].schema
    return STAGING[table].raw_schema if layer == RAW else STAGING[table].schema


def _table_name(path: str) -> str:
    """The session's name for a bucketed table; the files need no catalogue."""
    return f"lake_{hashlib.sha256(path.encode()).hexdigest()[:32]}"


def new_run_id() -> str:
    return f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def read_if_exists(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


@dataclass(frozen=True)
class Lake:
    """``buckets`` is how many new runs get; as many as shuffle partitions unless given."""

    spark: SparkSession
    root: str
    buckets: int | None = None

    def path(self, run_id: str, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/run={run_id}/{layer}/{table}"

    def write(self, df: DataFrame, run_id: str, layer: str, table: str) -> DataFrame:
        """Replace the table of a run that is not published yet and return it as read back."""
        if self.is_published(run_id):
            raise ValueError(f"The run '{run_id}' is published and can't be written again.")
        path = self.path(run_id, layer, table)
        if layer != RAW and BUCKET_KEY in df.columns:
            n = self._decided_buckets(run_id)
            name = _table_name(path)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_folder(self.spark, path)  # what a failed attempt left
            writer = df.repartition(n, BUCKET_KEY).write.bucketBy(n, BUCKET_KEY).sortBy(BUCKET_KEY)
            writer.option("path", path).saveAsTable(name)
            return self.spark.table(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, layer: str, table: str, run_id: str | None = None) -> DataFrame:
        run_id = run_id or self.current_run()
        if run_id is None:
            raise FileNotFoundError(f"Nothing is published in {self.root}.")
        schema, path = _schema(layer, table), self.path(run_id, layer, table)
        n = self._stored_buckets(run_id) if layer != RAW and BUCKET_KEY in schema.names else None
        if n is None:
            return self.spark.read.schema(schema).parquet(path)
        name = _table_name(path)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
                f" CLUSTERED BY ({BUCKET_KEY}) SORTED BY ({BUCKET_KEY}) INTO {n} BUCKETS"
                f" LOCATION '{path}'"
            )
        return self.spark.table(name)

    @property
    def _layouts(self) -> str:
        return f"{self.root.rstrip('/')}/layouts"

    def _stored_buckets(self, run_id: str) -> int | None:
        layouts = records(self.spark, self._layouts, _LAYOUT_SCHEMA)
        row = layouts.where(F.col("run_id") == run_id).first() if layouts is not None else None
        return row["buckets"] if row else None

    def _decided_buckets(self, run_id: str) -> int:
        """The number of buckets of a run: whoever writes its first table decides."""
        known = self._stored_buckets(run_id)
        if known is None:
            n = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            put_if_absent(
                self.spark, self._layouts, run_id.encode().hex(), {"run_id": run_id, "buckets": n}
            )
            known = self._stored_buckets(run_id)
        return known

    def read_layer(self, layer: str, tables, run_id: str | None = None) -> Mapping[str, DataFrame]:
        run_id = run_id or self.current_run()
        return {name: self.read(layer, name, run_id) for name in tables}

    @property
    def _log(self) -> str:
        return f"{self.root.rstrip('/')}/published"

    def _last_entry(self):
        log = records(self.spark, self._log, _LOG_SCHEMA)
        if log is None:
            return None
        # max_by keeps one row however long the log is.
        return log.agg(
            F.max("sequence").alias("sequence"), F.max_by("run_id", "sequence").alias("run_id")
        ).first()

    def is_published(self, run_id: str) -> bool:
        log = records(self.spark, self._log, _LOG_SCHEMA)
        return log is not None and not log.where(F.col("run_id") == run_id).isEmpty()

    def current_run(self) -> str | None:
        entry = self._last_entry()
        return entry["run_id"] if entry else None

    def publish(self, run_id: str) -> int:
        """Make a run the current one; the sequence number it got."""
        while True:
            last = self._last_entry()
            sequence = (last["sequence"] or 0) + 1 if last else 1
            entry = {
                "sequence": sequence,
                "run_id": run_id,
                "published_at": datetime.now(UTC).isoformat(),
            }
            if put_if_absent(self.spark, self._log, f"{sequence:012d}", entry):
                return sequence
