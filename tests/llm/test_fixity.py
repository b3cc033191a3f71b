import random

import pytest
from pyspark.sql import functions as F

from paddock.llm import fixity


def _records(files=4, n=200):
    rng, out = random.Random(4), []
    for f in range(files):
        at = 0
        for i in range(n if f else 3 * n):
            size = rng.choice([10, 200, 5000])
            out.append((f, at, size, f"d{f}-{i}"))
            at += size
    return out


SCHEMA = "file long, offset long, length long, digest string"


@pytest.mark.parametrize("range_bytes", [64, 4096, 1 << 30])
def test_damage_is_located(spark, range_bytes):
    left = _records()
    right = [r for i, r in enumerate(left) if i % 101 != 5]
    right = [(*r[:3], "bad") if i % 67 == 3 else r for i, r in enumerate(right)] + [(9, 0, 5, "new"), left[0]]
    got = fixity.audit(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), range_bytes).collect()
    a, b = {r[:2]: r for r in left}, {r[:2]: r for r in right}
    want = {k: "missing" if k not in b else "extra" if k not in a else "changed" for k in a.keys() | b.keys() if a.get(k) != b.get(k)}
    assert {(r["file"], r["offset"]): r["kind"] for r in got} == want and len(got) == len(want)
    assert all(r["range_start"] <= r["offset"] < r["range_stop"] for r in got)


@pytest.mark.parametrize("range_bytes", [64, 1 << 30])
def test_records_without_a_file_or_offset(spark, range_bytes):
    kept = [(None, 0, 10, "k"), (1, 0, 10, "k"), (2, None, 10, "k"), *[(None, 1000 * i, 10, f"n{i}") for i in range(5, 40)]]
    left = kept + [(None, 100, 10, "a"), (None, 200, 10, "b"), (1, None, 10, "c"), (3, None, 7, None), (None, None, 5, "f")]
    right = kept + [(None, 100, 10, "bad"), (None, 300, 10, "new"), (3, None, None, "7"), (None, None, 5, "f"), (None, None, 6, "g"), (4, None, 1, "h")]
    got = fixity.audit(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), range_bytes).collect()
    want = {(None, 100): "changed", (None, 200): "missing", (None, 300): "extra", (1, None): "missing", (3, None): "changed",
            (None, None): "changed", (4, None): "extra"}
    assert {(r["file"], r["offset"]): r["kind"] for r in got} == want and len(got) == len(want)


def test_equal_and_empty_replicas(spark):
    frame = spark.createDataFrame(_records(2, 50), SCHEMA)
    assert fixity.audit(frame, frame).count() == 0
    assert fixity.audit(frame.limit(0), frame.limit(0)).count() == 0
    assert fixity.audit(frame, frame.limit(0)).count() == frame.count()


def test_one_root_per_file(spark):
    levels = fixity.tree(spark.createDataFrame(_records(), SCHEMA), 256)
    assert levels[-1].count() == 4
    assert levels[-1].agg(F.sum("n")).first()[0] == 200 * 3 + 200 * 3
