"""Approximate neighbours against all pairs."""

from pathlib import Path

import numpy as np
import pytest

from paddock import queries as registered
from paddock.queries import registry

FOLDER = Path("/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not there")


def _found(spark, name):
    registered.load()
    rows = [tuple(r) for r in registry.QUERIES[name](spark, str(FOLDER)).collect()]
    found = {r[:2]: r[2] for r in rows}
    assert len(found) == len(rows)
    return found


def _compare(found, want):
    assert len(want) > 3 and found.keys() <= want.keys()
    assert all(abs(found[k] - want[k]) < 1e-3 for k in found)
    assert len(found) >= 0.9 * len(want)


def test_documents_near_to_every_50th(spark):
    docs = {r["doc_id"]: {w for w in (r["text"] or "").lower().split() if w} for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    want = {}
    for i, a in docs.items():
        for j, b in docs.items() if i % 50 == 0 and a else ():
            distance = 1 - len(a & b) / len(a | b)
            if i != j and b and distance <= 0.3:
                want[i, j] = distance
    _compare(_found(spark, "m23_set_neighbours"), want)


def test_vectors_near_to_every_50th(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in rows}
    apart = {(i, j): float(np.linalg.norm(a - b)) for i, a in vectors.items() if i % 50 == 0 for j, b in vectors.items() if i != j}
    _compare(_found(spark, "m23_projection_neighbours"), {k: d for k, d in apart.items() if d < 1.1})
