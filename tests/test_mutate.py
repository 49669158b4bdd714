"""Every sequence of operations up to length 4 against a plain interpreter of the rules, in both modes."""

import itertools

import pytest

from siltworks.operators import mutate


def interpreted(old, ops, mode):
    rows, pending, removed = list(old), None, False
    for i, op in enumerate(ops):
        if op in "UD":
            if mode == "key" or pending is None:
                removed = True
            pending = None
        if op in "UI":
            pending = i
    return ([] if removed else rows) + ([pending] if pending is not None else [])


@pytest.mark.parametrize("mode", ["key", "writer"])
def test_all_sequences(spark, mode):
    sequences = ["".join(s) for n in range(1, 5) for s in itertools.product("IUD", repeat=n)]
    batch = [(k, i, 0, i, op) for k, s in enumerate(sequences) for i, op in enumerate(s)]
    table = spark.createDataFrame([(k, -1) for k in range(len(sequences))], "k int, v int")
    batch = spark.createDataFrame(batch, "k int, v int, w int, _offset int, _op string")
    out = mutate.apply(table, batch, ["k"], ["_offset"], mode=mode, writer=["w"]).collect()
    found = {k: sorted(r["v"] for r in out if r["k"] == k) for k in range(len(sequences))}
    assert found == {k: sorted(interpreted([-1], s, mode)) for k, s in enumerate(sequences)}


def test_null_keys_are_equal(spark):
    table = spark.createDataFrame([(None, 1)], "k int, v int")
    batch = spark.createDataFrame([(None, 2, 0, "U")], "k int, v int, _offset int, _op string")
    assert [tuple(r) for r in mutate.apply(table, batch, ["k"], ["_offset"]).collect()] == [(None, 2)]


def test_operations(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(x,) for x in (" update", "d", "Delete", "c", "", None)], "op string")
    assert [r[0] for r in rows.select(mutate.operation(F.col("op"))).collect()] == ["U", "D", "D", "I", "I", "I"]
