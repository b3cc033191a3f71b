import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paddock.llm import vector_codes as op

rng = random.Random(11)
SCHEMA = "vec_id long, embedding array<double>, label int, codes string, _x int"


def _plain(rows, entries, rounds=4, parts=4):
    """Codes, errors and the written codebooks, one comparison at a time."""
    kept = [(i, [math.floor(1024 * x) for x in v], g) for i, v, g, *_ in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    length = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    cut = [[(v + [0] * length * parts)[p * length:(p + 1) * length] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p][:] for k in first] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            out.append([min((sum((a - b) ** 2 for a, b in zip(c[p], e)), n) for n, e in enumerate(books[p])) for p in range(parts)])
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for n in range(len(books[p])):
                mine = [cut[k][p] for k in range(len(cut)) if found[k][p][1] == n]
                if mine:
                    books[p][n] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    error = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, g), e in zip(kept, error):
        total[g] = total.get(g, 0) + e
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    coded = sorted(((i, "".join(f"{n:02x}" for _, n in f), e if e < 1 << 63 else None, total[g] if total[g] < 1 << 63 else None)
                    for (i, _, g), f, e in zip(kept, found, error)), key=key)
    return coded, hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest(), key


def _compare(spark, rows, entries=8):
    coded, books = op.compress(spark.createDataFrame(rows, SCHEMA), entries=entries)
    got = op.with_label_errors(coded).select("vec_id", op.code_hex().alias("code"), "error", "label_error").collect()
    want, digest, key = _plain(rows, entries)
    assert sorted((tuple(r) for r in got), key=key) == want
    assert (books.digest() if books else hashlib.sha256(b"").hexdigest()) == digest


def _rows(n=120, size=10, wide=1.0):
    rows = [(i // 2 if i < 10 else i, [rng.gauss(0, wide) for _ in range(size)], rng.choice([None, 1, 2]), "c", 1) for i in range(n)]
    return rows + rows[20:30]


def test_against_plain_rounds(spark):
    rows = _rows() + [(None, [0.5] * 10, 1, None, None), (500, None, 1, None, None), (501, [None] * 10, 1, None, None),
                      (502, [float("nan")] + [0.0] * 9, 2, None, None), (503, [float("-inf")] * 10, 2, None, None),
                      (504, [], 2, None, None), (505, [1.0, -2.0], None, None, None)]
    rng.shuffle(rows)
    _compare(spark, rows)


def test_large_components_stay_exact(spark):
    _compare(spark, _rows(40, 8, 1e6) + [(900, [1e15] * 8, 1, "", 0), (901, [-1e15] * 8, 1, "", 0), (902, [1.0] * 8, None, "", 0)])


def test_fewer_rows_than_entries_ties_and_none(spark):
    _compare(spark, [(3, [1.0] * 4, None, "", 0), (1, [1.0] * 4, None, "", 0), (2, [0.0, 2.0, 1.0, 1.0], 5, "", 0)], 256)
    _compare(spark, [(3, [], None, "", 0)], 256)
    _compare(spark, [(3, None, None, "", 0)], 256)
    _compare(spark, [], 256)


def test_many_labels_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_LABELS", 0)
    _compare(spark, _rows())


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_transform_keeps_distances(size):
    matrix = op.walsh(size)
    assert (matrix @ matrix.T == size * np.eye(size, dtype=int)).all()
    assert [(np.diff(r) != 0).sum() for r in matrix] == list(range(size))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 20), st.integers(1, 30), st.integers(0, 2**32 - 1), st.sampled_from([3, 1000, 2**40]))
def test_early_elimination_changes_nothing(length, n, seed, wide):
    draw = np.random.default_rng(seed)
    parts, entries = draw.integers(-wide, wide, (40, length)), draw.integers(-wide, wide, (n, length))
    place, far = op.nearest(parts, entries)
    full = ((parts[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2)
    assert (place == np.array([list(f).index(min(f)) for f in full])).all() and (far == full.min(axis=1)).all()
