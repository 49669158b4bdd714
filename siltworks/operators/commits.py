"""What a commit is made of: progress of the log, files without duplicates, and which of them are new."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def offsets(records: DataFrame) -> DataFrame:
    """Per log partition the next offset, and the timestamp of the last record (not the largest one)."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"), F.max_by("timestamp", "offset").alias("last_timestamp"))


def valid_through(assignment: DataFrame, progress: DataFrame, partial: bool = False) -> DataFrame:
    """One row: the smallest last timestamp over all assigned partitions, null if any has none or a writer is missing."""
    all_of = assignment.join(progress, ["topic", "partition"], "left")
    known = (F.count_if(F.col("last_timestamp").isNull()) == 0) & F.lit(not partial)
    return all_of.agg(F.when(known, F.min("last_timestamp")).alias("vtts"))


def ready(events: DataFrame, commit_id: str, total: int) -> DataFrame:
    """One row: how many partitions have answered this commit, and whether that is all of them."""
    own = events.where(F.col("commit_id") == commit_id)
    n = F.coalesce(F.sum("n_assignments"), F.lit(0))
    return own.agg(n.alias("n_ready"), (n >= total).alias("is_ready"))


def distinct_files(files: DataFrame, order: str = "event_seq") -> DataFrame:
    """Each path once: the one that came first; repeats are combined before the shuffle."""
    return files.groupBy("path").agg(F.min_by(F.struct(*files.columns), order).alias("_first")).select("_first.*")


def not_empty(files: DataFrame) -> DataFrame:
    return files.where("record_count > 0")


def uncommitted(events: DataFrame, committed: DataFrame) -> DataFrame:
    """Events at or after the next offset that is stored for their partition; unknown partitions keep all."""
    done = committed.select("partition", F.col("next_offset").alias("_next"))
    return events.join(done, "partition", "left").where(F.col("_next").isNull() | (F.col("offset") >= F.col("_next"))).drop("_next")


@dataclass(frozen=True)
class File:
    """A written file: data, or the keys of deleted rows."""

    path: str
    record_count: int
    content: str = "data"
    spec_id: int = 0


@dataclass(frozen=True)
class Response:
    """What one writer answers to a commit: its files, and the progress of its partitions (offset, millis)."""

    commit_id: str
    offset: int
    files: tuple[File, ...] = ()
    partition: int = 0
    progress: Mapping[tuple[str, int], tuple[int | None, int | None]] = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    """One planned snapshot: an append of one partition spec's files, or a single row delta."""

    operation: str
    files: tuple[File, ...]
    summary: Mapping[str, str]


def plan_commit(
    responses: Sequence[Response],
    commit_id: str,
    committed: Mapping[int, int],
    *,
    partial: bool = False,
    prefix: str = "kafka.connect.",  # as readers of the summary know it
    topic: str = "control",
    group: str = "group",
) -> list[Snapshot]:
    """The snapshots of one table for an interval; none if no file is left.

    Responses before the committed offsets of their partition are dropped, then repeated paths, then empty
    files.  With delete files there is one row delta; else one append per partition spec.  Offsets and the
    valid-through time stand in the last snapshot only.
    """
    import json

    fresh = [r for r in responses if r.partition not in committed or r.offset >= committed[r.partition]]
    files = [f for f in _once(f for r in fresh for f in r.files) if f.record_count > 0]
    if not files:
        return []
    done = dict(committed)
    for r in fresh:
        done[r.partition] = max(done.get(r.partition, 0), r.offset + 1)
    times = [t for r in fresh for _, t in r.progress.values()]
    last = {f"{prefix}offsets.{topic}.{group}": json.dumps({str(k): v for k, v in sorted(done.items())}, separators=(",", ":")), f"{prefix}commit-id": commit_id}
    if times and not partial and all(t is not None for t in times):
        last[f"{prefix}vtts"] = str(min(times))
    if any(f.content == "deletes" for f in files):
        return [Snapshot("overwrite", tuple(files), last)]
    specs = sorted({f.spec_id for f in files})
    groups = [tuple(f for f in files if f.spec_id == s) for s in specs]
    return [Snapshot("append", g, last if k == len(groups) - 1 else {f"{prefix}commit-id": commit_id}) for k, g in enumerate(groups)]


def _once(files: Iterable[File]) -> list[File]:
    return list({(f.content, f.path): f for f in reversed(list(files))}.values())[::-1]
