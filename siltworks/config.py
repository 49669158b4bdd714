"""What an ingestion job is told: tables, routing, keys, creation and evolution, commits."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field


def split_list(text: str | None) -> list[str]:
    """A comma-separated list, without blanks."""
    return [x.strip() for x in (text or "").split(",") if x.strip()]


def split_spec(text: str | None) -> list[str]:
    """A comma-separated list whose commas inside parentheses don't separate."""
    out, depth, own = [], 0, ""
    for c in text or "":
        depth += (c == "(") - (c == ")")
        if c == "," and depth <= 0:
            out.append(own.strip())
            own = ""
        else:
            own += c
    return [x for x in [*out, own.strip()] if x]


@dataclass(frozen=True)
class TableConfig:
    """Settings of one table; what is None falls back to the job's default."""

    route_regex: str | None = None
    id_columns: tuple[str, ...] | None = None
    partition_by: tuple[str, ...] | None = None
    commit_branch: str | None = None


@dataclass(frozen=True)
class EngineConfig:
    """One job.  Either ``tables`` or ``dynamic`` names where records go."""

    name: str = "job"
    tables: tuple[str, ...] = ()
    dynamic: bool = False
    route_field: str | None = None
    default_commit_branch: str | None = None
    default_id_columns: tuple[str, ...] = ()
    default_partition_by: tuple[str, ...] = ()
    cdc_field: str | None = None
    upsert: bool = False
    auto_create: bool = False
    force_optional: bool = False
    case_insensitive: bool = False
    evolve_schema: bool = False
    catalog: str = "iceberg"  # the name that a job without one has always had
    control_topic: str = "control-iceberg"
    control_group: str = ""
    connect_group: str = ""
    commit_interval_ms: int = 300_000
    commit_timeout_ms: int = 30_000
    commit_threads: int = field(default_factory=lambda: 2 * (os.cpu_count() or 1))
    hadoop_conf_dir: str | None = None
    catalog_props: Mapping[str, str] = field(default_factory=dict)
    hadoop_props: Mapping[str, str] = field(default_factory=dict)
    kafka_props: Mapping[str, str] = field(default_factory=dict)
    auto_create_props: Mapping[str, str] = field(default_factory=dict)
    write_props: Mapping[str, str] = field(default_factory=dict)
    per_table: Mapping[str, TableConfig] = field(default_factory=dict)
    #: "key": a delete or update removes the key's earlier rows; "writer": only where a writer emits a delete by key.
    mutations: str = "key"
    #: "table": mutations reach the key's rows in any partition; "partition": only those in the new row's partition.
    delete_scope: str = "table"
    #: A table is rewritten without its deletes when so many writes of deleted keys have piled up; 0: never.
    compact_after: int = 64

    def __post_init__(self) -> None:
        if bool(self.tables) == self.dynamic:
            raise ValueError("name tables, or set dynamic routing, but not both")
        if self.dynamic and not self.route_field:
            raise ValueError("dynamic routing needs a route field")
        if self.mutations not in ("key", "writer") or self.delete_scope not in ("table", "partition"):
            raise ValueError("mutations is key or writer, delete_scope is table or partition")
        for own, name in (("control_group", f"cg-control-{self.name}"), ("connect_group", f"connect-{self.name}")):
            if not getattr(self, own):
                object.__setattr__(self, own, name)

    def table(self, name: str) -> TableConfig:
        """The settings of the table ``name``, defaults filled in."""
        own = self.per_table.get(name, TableConfig())
        return TableConfig(
            own.route_regex,
            self.default_id_columns if own.id_columns is None else own.id_columns,
            self.default_partition_by if own.partition_by is None else own.partition_by,
            own.commit_branch or self.default_commit_branch,
        )

    @classmethod
    def from_properties(cls, props: Mapping[str, str]) -> EngineConfig:
        """From string properties ``<prefix>.<setting>``; the prefix is that of the catalog's properties.

        Write properties are read with the documented and with the shorter prefix.  Catalog properties are
        mandatory.
        """
        found = [m[1] for k in props if (m := re.match(r"([^.]+)\.catalog\.", k))]
        if not found:
            raise ValueError("catalog properties are missing")
        prefix = found[0]

        def text(key: str) -> str | None:
            return props.get(f"{prefix}.{key}")

        def flag(key: str) -> bool:
            return (text(key) or "false").strip().lower() == "true"

        def below(*keys: str) -> dict[str, str]:
            return {k[len(p) :]: v for key in keys for k, v in props.items() if k.startswith(p := f"{prefix}.{key}.")}

        def group(key: str, of) -> tuple[str, ...] | None:
            return None if text(key) is None else tuple(of(text(key)))

        tables = tuple(split_list(text("tables")))
        own = {}
        names = {m[1] for k in props if (m := re.match(rf"{re.escape(prefix)}\.table\.(.+)\.(route-regex|id-columns|partition-by|commit-branch)$", k))}
        for t in names:
            at = f"table.{t}"
            own[t] = TableConfig(text(f"{at}.route-regex"), group(f"{at}.id-columns", split_list), group(f"{at}.partition-by", split_spec), text(f"{at}.commit-branch"))
        given = {
            "catalog": text("catalog"),
            "control_topic": text("control.topic"),
            "control_group": text("control.group-id"),
            "connect_group": text("connect.group-id"),
            "commit_interval_ms": text("control.commit.interval-ms"),
            "commit_timeout_ms": text("control.commit.timeout-ms"),
            "commit_threads": text("control.commit.threads"),
        }
        given = {k: int(v) if k.startswith("commit_") else v for k, v in given.items() if v is not None}
        return cls(
            name=props.get("name", "job"),
            tables=tables,
            dynamic=flag("tables.dynamic-enabled"),
            route_field=text("tables.route-field"),
            default_commit_branch=text("tables.default-commit-branch"),
            default_id_columns=tuple(split_list(text("tables.default-id-columns"))),
            default_partition_by=tuple(split_spec(text("tables.default-partition-by"))),
            cdc_field=text("tables.cdc-field"),
            upsert=flag("tables.upsert-mode-enabled"),
            auto_create=flag("tables.auto-create-enabled"),
            force_optional=flag("tables.schema-force-optional"),
            case_insensitive=flag("tables.schema-case-insensitive"),
            evolve_schema=flag("tables.evolve-schema-enabled"),
            hadoop_conf_dir=text("hadoop-conf-dir"),
            catalog_props=below("catalog"),
            hadoop_props=below("hadoop"),
            kafka_props=below("kafka"),
            auto_create_props=below("tables.auto-create-props"),
            write_props=below("tables.write-props", "table.write-props"),
            per_table=own,
            **given,
        )

    def spark_conf(self) -> dict[str, str]:
        """Session settings for an external catalog and its file systems.

        A configuration folder's files come after the class path's, explicit properties after both.
        """
        out = {f"spark.sql.catalog.{self.catalog}.{k}": v for k, v in self.catalog_props.items()}
        return out | {f"spark.hadoop.{k}": v for k, v in {**self._conf_files(), **self.hadoop_props}.items()}

    def _conf_files(self) -> dict[str, str]:
        import xml.etree.ElementTree as ET

        out: dict[str, str] = {}
        for name in ("core-site.xml", "hdfs-site.xml", "hive-site.xml"):
            path = os.path.join(self.hadoop_conf_dir or "", name)
            if self.hadoop_conf_dir and os.path.exists(path):
                for p in ET.parse(path).getroot().iter("property"):
                    out[p.findtext("name", "")] = p.findtext("value", "")
        return out
