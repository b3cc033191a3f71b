import hashlib
import random

import pytest
from helpers import hits

from paddock.llm import decontaminate

rng = random.Random(3)
WORDS = [f"w{i}" for i in range(60)] + ["The", "é9", "naïve"]


def _data():
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.choice([3, 10, 12, 25])))) for i in range(12)]
    items += [(2, items[2][1]), (50, ""), (51, None), (None, "lonely words"), (52, "ZZ"), (53, "the the the the the the the the the the the")]
    docs = []
    for i in range(60):
        w = [rng.choice(WORDS) for _ in range(rng.randrange(0, 80))]
        if i % 3 == 0:
            body = items[i % 12][1].upper().split(" ")
            at = rng.randrange(len(w) + 1)
            w[at:at] = body[: rng.randrange(1, len(body) + 1)]
        docs.append((i, rng.choice([" ", ", ", "--\n"]).join(w)))
    docs += [(7, docs[7][1]), (7, "lonely, WORDS!"), (100, None), (101, ""), (None, "x zz y"), (102, "the " * 500)]
    return docs, items


@pytest.fixture(scope="module")
def frames(spark):
    docs, items = _data()
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def _want(docs, items):
    out = []
    for i, text in docs:
        n, hit, found = hits(text, items)
        out.append((-1 if i is None else i, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0))
    return sorted(out)


def _got(frame):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in frame.collect())


@pytest.mark.parametrize("limit", [0, 200_000])
def test_against_plain_search(frames, monkeypatch, limit):
    docs, items, d, b = frames
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    assert _got(decontaminate.contamination(d, b)) == _want(docs, items)


def test_empty_sides(frames):
    docs, _, d, b = frames
    assert _got(decontaminate.contamination(d, b.limit(0))) == _want(docs, [])
    assert decontaminate.contamination(d.limit(0), b).count() == 0


def test_contaminated_documents_go_and_columns_stay(frames):
    docs, items, d, b = frames
    named = d.withColumn("n_words", d["doc_id"])
    kept = decontaminate.drop_contaminated(named, b)
    assert kept.columns == named.columns
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()) == sorted(
        (i or -1, t or "") for i, t in docs if not hits(t, items)[1])


def test_proximity_finds_words_out_of_order(spark):
    d = spark.createDataFrame([(1, "x x alpha gamma beta delta x x"), (2, "alpha x x x x x x beta"), (3, "alpha beta gamma delta")], "doc_id long, text string")
    b = spark.createDataFrame([(9, "alpha beta gamma delta")], "item_id long, text string")
    _, found, _ = decontaminate.matches(d, b, slop=1)
    kinds = {r["_key"].split(":")[0]: {s["kind"] for s in r["spans"]} for r in found.collect()}
    assert kinds == {"1": {"proximity"}, "3": {"phrase"}} or kinds == {"1": {"proximity"}, "3": {"phrase", "proximity"}}


def test_proximity_finds_words_moved_from_end_to_end(spark):
    # alpha and beta are the rarest; beta moves from the end of the window to its start, and alpha likewise.
    texts = ["alpha beta b c d e f g", "b c d e f g beta alpha", "beta alpha b c d e f g", "alpha b beta c d e f g", "x x beta b c alpha d e f g"]
    item = "alpha b c d e f g beta"
    common = [f"b c d e f g b c d e f g {i}" for i in range(8)]
    d = spark.createDataFrame(list(enumerate(texts + common)), "doc_id long, text string")
    _, found, _ = decontaminate.matches(d, spark.createDataFrame([(9, item)], "item_id long, text string"), slop=1)
    got = {int(r["_key"].split(":")[0]) for r in found.collect() if r["spans"]}
    want = set()
    for i, text in enumerate(texts + common):
        have, wanted = text.split(), item.split()
        # The place is that of the rarest word, either of the two as they are equally rare.
        for at, word in enumerate(have):
            start = at - wanted.index("alpha") if word == "alpha" else None
            if start is not None and sorted(set(wanted) - set(have[max(0, start - 1):start + len(wanted) + 1])) == []:
                want.add(i)
    assert {0, 2, 3} <= want and got >= want
