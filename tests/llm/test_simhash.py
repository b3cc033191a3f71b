import random

import numpy as np
import pytest
from helpers import classes, simhash
from hypothesis import given, settings
from hypothesis import strategies as st

from paddock.llm import simhash as op

rng = random.Random(5)
VOCABULARY = [f"{a}{b}" for a in "abcdefgh" for b in ("on", "er", "il", "am", "us")]


def _texts():
    out = [None, "", "  \n", "a", "A b C", "a b c d", "A B\tc\nd", "e\u00a0f g h i j", "É é a b c"]
    for _ in range(12):
        base = [rng.choice(VOCABULARY) for _ in range(200)]
        out.append(" ".join(base))
        for _ in range(6):
            near = base[:]
            near[rng.randrange(200)] = "changed"
            out.append(" ".join(near))
    return out + out[:5] + ["x y " * 40_000]


def test_fingerprints_and_components(spark):
    texts = _texts()
    ids = [None if i == 3 else i // 2 * 2 if i > 60 else i for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["_print"] & (2**64 - 1), r["component_id"])
                 for r in op.components(docs).collect())
    prints = [simhash(t) for t in texts]
    want = sorted((-1 if i is None else i, p, c) for i, p, c in zip(ids, prints, classes(prints, ids)))
    assert got == want


@pytest.mark.parametrize("tile", [4, 50, 1000])
def test_tiles_of_any_size_link_the_same(spark, tile):
    values = {rng.getrandbits(64) for _ in range(120)}
    values |= {v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in list(values)[:60]}
    values = sorted(values)
    frame = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "_print long")
    edges = [(r["src"] & (2**64 - 1), r["dst"] & (2**64 - 1)) for r in op.link_prints(frame, tile=tile).collect()]
    group = {v: v for v in values}

    def root(v):
        while group[v] != v:
            v = group[v]
        return v

    for a, b in edges:
        group[max(root(a), root(b))] = min(root(a), root(b))
    assert [root(v) for v in values] == classes(values, values)


def test_a_large_group_gives_a_forest():
    values = np.sort(np.array([rng.getrandbits(64)] * 1, dtype=np.uint64) ^ (np.uint64(1) << np.arange(64, dtype=np.uint64)))
    src, _ = op.tile_links(values, values, True)
    assert len(src) == 63


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBz \n\té.", max_size=60))
def test_fingerprint_of_any_text(text):
    assert op.fingerprint(text.encode()) == simhash(text)


def test_one_row_of_every_group_stays(spark):
    docs = spark.createDataFrame([(5, "a b c d e f", "x"), (3, "A b c d e f", "y"), (3, "A b c d e f", "y"), (9, "other words here now", None),
                                  (None, None, "n")], "doc_id long, text string, _first string")
    kept = op.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["_first"]) for r in kept.collect()) == [(0, "n"), (3, "y"), (9, None)]
    assert op.drop_near_copies(docs.limit(0)).count() == 0


def test_every_group_stays_whatever_its_ids(spark):
    one, two, three = "a b c d e f", "other words here now", "nothing like those at all"
    docs = spark.createDataFrame([(None, one, "n1"), (None, one, "n1"), (None, two, "n2"), (7, three, "s1"), (7, "quite another story", "s2"),
                                  (8, three, "later")], "doc_id long, text string, tag string")
    assert sorted(r["tag"] for r in op.drop_near_copies(docs).collect()) == ["n1", "n2", "s1", "s2"]
