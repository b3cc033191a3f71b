from collections import Counter

import pytest
from helpers import repeat_words, words

from paddock.llm import quality

TEXTS = [
    None, "", "  \n\t ", "one", "a b c a b c", "x y z\nx y z\n\n x y z", "a a a a a a", "#*$ %&| <> ok",
    "b " * 60, " ".join(f"word{i}" for i in range(70)), "p q r s p q r s t p q", "line\nline\nline\nother\n \n \n",
    " ".join(f"w{i % 7}" for i in range(4000)), "\u00a0\u3000 x", "dup\x0bdup\x0cdup dup",
]


@pytest.fixture(scope="module")
def entries(spark):
    docs = spark.createDataFrame([(i, t, "kept", 7) for i, t in enumerate(TEXTS + TEXTS)], "doc_id long, text string, failed string, n_words int")
    return {r["doc_id"]: r for r in quality.decide(quality.ledger(docs), quality.POLICIES["base"]).collect()}


def test_measures_against_plain_counts(entries):
    for i, text in enumerate(TEXTS + TEXTS):
        row, w = entries[i], words(text)
        lines = [x for x in (text or "").split("\n") if words(x)]
        assert row["n_words"] == len(w), text
        assert row["word_chars"] == sum(map(len, w))
        assert row["n_symbols"] == sum((text or "").count(s) for s in "#*$%&|<>")
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == repeat_words(text), text


def test_bits_and_policies(entries):
    for row in entries.values():
        base = row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"]
        assert row["kept"] == (not base)
        assert bool(row["failed"] & 1) == (row["n_words"] < 50)
        assert bool(row["failed"] & 4) == (10 * row["n_symbols"] > row["n_words"])


def test_ablations_count_what_each_rule_does(spark):
    masks = [0, 0, 1, 1, 3, 2, 5]
    policy = quality.Policy("t", ("short", "repeats"))
    rows = quality.ablations(spark.createDataFrame([(m,) for m in masks], "failed long"), policy).collect()
    got = {r["rule"]: (r["failing"], r["only_this"], r["kept_without"]) for r in rows}
    two = Counter(m & 3 for m in masks)
    assert got["short"] == (two[1] + two[3], two[1], two[0] + two[1])
    assert got["repeats"] == (two[2] + two[3], two[2], two[0] + two[2])


def test_passing_keeps_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "w " * 10, 5), (2, TEXTS[9], 6), (2, TEXTS[9], 6), (None, None, 1)], "doc_id long, text string, n_words int")
    kept = quality.passing(docs, quality.POLICIES["v1"])
    assert kept.columns == docs.columns
    assert [tuple(r) for r in kept.collect()] == [(2, TEXTS[9], 6)] * 2
    assert quality.passing(docs.limit(0), quality.POLICIES["v1"]).count() == 0
