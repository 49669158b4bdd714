import pytest

from siltworks.config import EngineConfig, split_spec


def test_spec_lists_keep_commas_in_parentheses():
    assert split_spec("bucket(id, 4), type") == ["bucket(id, 4)", "type"]


def test_either_tables_or_dynamic():
    with pytest.raises(ValueError):
        EngineConfig()
    with pytest.raises(ValueError):
        EngineConfig(tables=("a",), dynamic=True, route_field="f")
    with pytest.raises(ValueError):
        EngineConfig(dynamic=True)


def test_from_properties():
    c = EngineConfig.from_properties(
        {
            "name": "n",
            "x.catalog.type": "rest",
            "x.tables": "a, b",
            "x.tables.route-field": "t",
            "x.table.a.route-regex": "q.*",
            "x.table.a.id-columns": "i, j",
            "x.tables.default-partition-by": "day(ts), bucket(i, 4)",
            "x.tables.upsert-mode-enabled": "true",
            "x.tables.write-props.p": "1",
            "x.table.write-props.q": "2",
            "x.control.commit.interval-ms": "1000",
            "x.hadoop.k": "v",
        }
    )
    assert c.tables == ("a", "b") and c.upsert and c.commit_interval_ms == 1000
    assert c.table("a").route_regex == "q.*" and c.table("a").id_columns == ("i", "j")
    assert c.table("b").partition_by == ("day(ts)", "bucket(i, 4)")
    assert c.write_props == {"p": "1", "q": "2"}
    assert c.control_group == "cg-control-n" and c.connect_group == "connect-n"
    assert c.spark_conf() == {"spark.sql.catalog.iceberg.type": "rest", "spark.hadoop.k": "v"}


def test_catalog_is_mandatory():
    with pytest.raises(ValueError):
        EngineConfig.from_properties({"x.tables": "a"})
