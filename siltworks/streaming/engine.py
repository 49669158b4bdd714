"""The ingestion engine: the same batch function for whole logs and for streams of them.

A batch is transformed, routed, coerced to each table's schema (which is created or evolved first), folded
by key where it mutates rows, written, and committed as one snapshot per table with the log's progress.
Tables are committed side by side; if one fails the batch fails, and when it is run again the tables that
have its commit key are left alone, so every record counts exactly once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import EngineConfig, split_list
from ..functions import partition
from ..functions.coerce import Options, project
from ..functions.times import millis
from ..operators import commits, mutate, route
from ..operators.transforms import extract
from ..plans import schema as schemas
from ..sources.store import IDENTIFIER, MAIN, Store

POSITION = ("topic", "partition", "offset")
AUDIT = T.StructType([*[T.StructField(n, T.StringType()) for n in ("id", "type", "group_id", "commit_id", "payload")], T.StructField("ts", T.TimestampType())])
Transform = Callable[[DataFrame], DataFrame]

#: Up to this many tables with a route value each read the log themselves; beyond it, it is written by table first.
UNSTAGED = 2


def _storable(kind: T.DataType) -> bool:
    """Whether Parquet can hold values of this type: neither void nor a struct without fields anywhere."""
    text = kind.simpleString()
    return "void" not in text and "struct<>" not in text


class Engine:
    """Runs batches of a log into the tables of ``store``."""

    def __init__(
        self,
        spark: SparkSession,
        config: EngineConfig,
        store: Store,
        transforms: Sequence[Transform] = (),
        has_schema: bool = True,
        assigned: Sequence[tuple[str, int]] = (),
    ) -> None:
        """``assigned`` are log partitions that are read though they may be idle; those that had records once are known."""
        self.spark, self.config, self.store = spark, config, store
        self.transforms, self.has_schema = list(transforms), has_schema
        self.on_commit: list[Callable[[dict], None]] = []
        self.audit: str | None = None  # the name of a table that keeps the events
        self.assigned = set(assigned)
        spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")

    def run_batch(self, records: DataFrame, batch_id: int = 0, query_id: str = "batch") -> list[dict]:
        """Ingests ``records`` (envelope and ``value``); returns one event per table's commit, and one for all."""
        progress = {(r["topic"], r["partition"]): (r["next_offset"], r["last_timestamp"]) for r in commits.offsets(records).collect()}  # one per log partition
        self._known()
        cached = records.is_cached
        for transform in self.transforms:
            records = transform(records)
        field = None
        kind = records.schema["value"].dataType
        live = records.where(F.col("value").isNotNull())
        if self.config.route_field:
            field = extract(F.col("value"), kind, self.config.route_field)
        routed = route.route(live, self.config, field)
        commit_id = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{query_id}/{batch_id}"))
        several = self.config.dynamic or len(self.config.tables) > UNSTAGED
        staged = f"{self.store.root}/_staged-{uuid.uuid4().hex}" if field is not None and several and not cached and _storable(kind) else None
        try:
            if staged:
                routed = self._stage(routed, staged)
            names = [r[0] for r in routed.select(route.TABLE).distinct().collect()] if self.config.dynamic else list(self.config.tables)
            work = [lambda n=n: self._table(n, routed.where(F.col(route.TABLE) == n), kind, progress, commit_id, f"{query_id}/{batch_id}") for n in sorted(names)]
            with ThreadPoolExecutor(max(1, min(self.config.commit_threads, len(work) or 1))) as pool:
                events = [e for e in (f.result() for f in [pool.submit(w) for w in work]) if e]
        finally:
            if staged:
                folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
                folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        events.append({"type": "commit-complete", "commit_id": commit_id, "vtts": self._vtts(progress)})
        for event in events:
            for listener in self.on_commit:
                listener(event)
        self.assigned |= set(progress)
        if self.audit:
            self._keep(events, f"{query_id}/{batch_id}")
        return events

    def _stage(self, routed: DataFrame, path: str) -> DataFrame:
        """``routed``, written once with a folder per table: no table's work reads the log, or other tables' records.

        A driver that dies leaves the folder, which nothing reads.
        """
        rows = routed.withColumn("_to", F.concat(F.lit("_"), F.col(route.TABLE))).drop(route.TABLE)
        rows.write.partitionBy("_to").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path).withColumn(route.TABLE, F.expr("substring(_to, 2)")).drop("_to")

    def _keep(self, events: list[dict], key: str) -> None:
        """Appends the events to the audit table, once per batch."""
        table = self.store.table(self.audit)
        table.create(AUDIT)
        own = [(f"{key}/{i}", e["type"], self.config.control_group, e["commit_id"], json.dumps(e)) for i, e in enumerate(events)]
        rows = self.spark.createDataFrame(own, T.StructType(AUDIT.fields[:-1])).withColumn("ts", F.current_timestamp())
        table.publish([table.write(rows)], [], {"commit-key": f"{key}/{self.audit}"})

    def _vtts(self, progress: dict) -> int | None:
        """The smallest last time over all assigned partitions; None if one of them has no record in this batch."""
        times = [progress.get(p, (None, None))[1] for p in {*self.assigned, *progress}]
        return min(millis(t) for t in times) if times and all(times) else None

    def _known(self) -> None:
        """Partitions of earlier runs are assigned too."""
        for name in self.config.tables:
            branch = self.config.table(name).commit_branch or MAIN
            for where in self.store.table(name).offsets(self.config.control_topic, self.config.control_group, branch):
                topic, _, number = where.rpartition("-")
                self.assigned.add((topic, int(number)))

    def _table(self, name: str, rows: DataFrame, kind: T.DataType, progress: dict, commit_id: str, key: str) -> dict | None:
        config, own = self.config, self.config.table(name)
        table, branch = self.store.table(name), own.commit_branch or MAIN
        record = schemas.declared(kind, config.force_optional) if self.has_schema else kind
        if isinstance(kind, T.StringType):  # JSON records without a schema
            record = schemas.inferred_schema(rows)
            rows = rows.withColumn("value", F.parse_json("value"))
            kind = T.VariantType()
        if not table.exists():
            if not config.auto_create:
                if config.dynamic:
                    return None  # as records of unknown tables are dropped
                raise LookupError(f"table {name} does not exist")
            if not record.fields:
                return None
            identifier = {IDENTIFIER: ",".join(own.id_columns)} if own.id_columns else {}
            table.create(record, own.partition_by or (), {**identifier, **config.auto_create_props})
        state = table.load(branch)
        if config.evolve_schema:
            changes = schemas.diff(state.schema, record, has_schema=self.has_schema and not isinstance(kind, T.VariantType), case_insensitive=config.case_insensitive)
            if changes:
                state = table.evolve(changes, branch)
        where = F.concat_ws("/", *[F.col(c).cast("string") for c in POSITION])
        columns = project(F.col("value"), kind, state.schema, Options(case_insensitive=config.case_insensitive, where=where))
        properties = {**state.properties, **config.write_props}
        if config.cdc_field or config.upsert:
            keys = list(own.id_columns or split_list(state.properties.get(IDENTIFIER)))
            if not keys:
                raise ValueError(f"table {name} has no identifier fields, and none are configured: changes can't be applied")
            cdc = extract(F.col("value"), kind, config.cdc_field) if config.cdc_field else None
            batch = rows.select(*columns, mutate.resolved(cdc, config.upsert).alias(mutate.OP), *[F.col(c).alias(f"_{c}") for c in POSITION])
            order = [f"_{c}" for c in POSITION]
            scope = []
            if config.delete_scope == "partition":  # the partition's value, not the column that it is made of
                portable = properties.get(partition.BUCKET_HASH) == "portable"
                for f in partition.parse(state.spec):
                    scope.append(f"_p_{f.name}")
                    batch = batch.withColumn(scope[-1], partition.value(f, batch.schema[f.column].dataType, portable))
            on = [*keys, *scope]
            gone = mutate.touched(batch, on, order, config.mutations, ["_topic", "_partition"])
            new = mutate.survivors(batch, on, order).select(*state.schema.fieldNames())
            with ThreadPoolExecutor(2) as pool:  # neither write needs the other
                writes = [pool.submit(table.write, gone, content="deletes"), pool.submit(table.write, new, state.spec, properties=properties)]
                files = [w.result() for w in writes]
        else:
            files = [table.write(rows.select(*columns), state.spec, properties=properties)]
        summary = {"commit-key": f"{key}/{name}", "kafka.connect.commit-id": commit_id}
        if (vtts := self._vtts(progress)) is not None:
            summary["kafka.connect.vtts"] = str(vtts)
        offsets = {f"{t}-{p}": n for (t, p), (n, _) in progress.items()}
        done = table.publish(files, [], summary, branch, (f"{config.control_topic}.{config.control_group}", offsets))
        if done.number == state.number:
            return None  # no files, or committed before
        if config.compact_after and sum(f["content"] == "deletes" for f in done.files) >= config.compact_after:
            table.compact(branch)
        return {"type": "commit-table", "table": name, "snapshot": done.number, "commit_id": commit_id, "vtts": vtts}

    def start(self, records: DataFrame, checkpoint: str, *, available_now: bool = False):
        """Runs the engine on a stream, a batch per commit interval, or on what there is now."""
        query = records.writeStream.option("checkpointLocation", checkpoint)
        query = query.trigger(availableNow=True) if available_now else query.trigger(processingTime=f"{self.config.commit_interval_ms} milliseconds")
        name = f"{self.config.connect_group}"
        return query.foreachBatch(lambda batch, batch_id: self._stream_batch(batch, batch_id, name)).start()

    def _stream_batch(self, batch: DataFrame, batch_id: int, name: str) -> None:
        batch = batch.persist()
        try:
            self.run_batch(batch, batch_id, name)
        finally:
            batch.unpersist()
