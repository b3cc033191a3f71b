import random
import re
from itertools import permutations

import pytest
from helpers import words

from paddock.llm import interaction as op

rng = random.Random(13)
DOCS = "doc_id long, text string, source string, bits int, hash long, n int"
LABELS = "doc_id long, quality int, toxic int, id string"


def _fails(rows, text, name):
    w = words(text)
    bits = {"A"} if len(w) < 200 else set()
    bits |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
    bits |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
    bits |= {"D"} if re.search("[#$%&*|]", text) else set()
    if name is not None and any(i is not None and i < name and (t or "") == text for i, t, *_ in rows):
        bits.add("E")
    return bits


def _plain(rows, labels):
    docs = [((s or ""), _fails(rows, t or "", i), any(d == i is not None and q == 1 for d, q, _, _ in labels),
             any(d == i is not None and x == 1 for d, _, x, _ in labels)) for i, t, s, *_ in rows]
    out, removed = {}, {}
    for part in {p for p, *_ in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            for step, one in enumerate(order):
                before = set(order[:step])
                here = [d for d in mine if one in d[1] and not before & d[1]]
                removed[part, one] = removed.get((part, one), 0) + len(here)
                out[part, "".join(order), step + 1] = [
                    sum(not d[1] & (before | {one}) for d in mine), len(here), sum(one in d[1] and bool(before & d[1]) for d in mine),
                    sum(d[1] == {one} for d in mine), sum(d[2] for d in here), sum(d[3] for d in here)]
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def _rows():
    texts = [None, "", "  \n", "word " * 300, " ".join(f"w{i}" for i in range(250)), "A" * 50, "x # y", "É Ö " * 120,
             " ".join(f"W{i}" for i in range(220)) + " |", "tab\tand\vline\n" * 70, "long " * 100_000]
    rows = [(i, rng.choice(texts), rng.choice([None, "", "a", "b"]), 1, 2, 3) for i in range(90)]
    rows += [(None, "word " * 300, "a", 1, 2, 3), (None, None, None, None, None, None), rows[5], rows[5], (7, "own text", "b", 1, 2, 3)]
    rng.shuffle(rows)
    return rows


def _compare(spark, rows, labels):
    got = op.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got}
    assert len(found) == len(got) and found == _plain(rows, labels)


LABEL_ROWS = [(i, i % 2, i % 3 == 0 and 1 or None, "x") for i in range(0, 90, 2)] + [(4, 1, 1, None), (4, 0, 0, None), (None, 1, 1, None)]


def test_against_every_order_by_hand(spark):
    _compare(spark, _rows(), LABEL_ROWS)


@pytest.mark.parametrize("salt, broadcast", [(2, 500_000), (4_096, 0), (3, 1)])
def test_dealt_groups_and_shuffled_hashes_mark_the_same(spark, monkeypatch, salt, broadcast):
    monkeypatch.setattr(op, "SALT_ROWS", salt)
    monkeypatch.setattr(op, "BROADCAST_HASHES", broadcast)
    _compare(spark, _rows(), LABEL_ROWS)


def test_texts_with_one_hash_are_told_apart(spark):
    rows = [(1, "one", 9, "p"), (2, "two", 9, "p"), (3, "one", 9, "p"), (None, "two", 9, "p")]
    docs = spark.createDataFrame(rows, "id long, text string, hash long, part string")
    assert [r["id"] for r in op.repeats(docs).collect()] == [3]


def test_without_rows_and_without_labels(spark):
    _compare(spark, [], LABEL_ROWS)
    _compare(spark, _rows()[:10], [])
