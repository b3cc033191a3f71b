import random
import zlib
from array import array
from collections import Counter, defaultdict

import pytest
import public_tokenizers
from helpers import one_by_one
from tokenizers import Tokenizer

from paddock.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(6))
def test_the_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100])
    lengths = [rng.choice([rng.randint(1, capacity), rng.randint(1, 5), capacity // 3 + 1]) for _ in range(rng.randint(1, 500))]
    runs, opened = packing.plan(Counter(lengths), capacity)
    loads, at = defaultdict(int), 0
    for run in runs:
        assert run.rank == at
        at += run.count
        for k in range(run.count):
            place = run.first + k // run.per
            assert loads[place] == run.used + k % run.per * run.length
            loads[place] += run.length
    assert at == len(lengths)
    assert (opened, sorted(loads.values())) == one_by_one(lengths, capacity)


def test_documents_fill_sequences_without_gaps(spark):
    rng = random.Random(1)
    texts = [None, "", "  ", "one"] + [" ".join(rng.choice(["alpha", "be", "gamma's", "12"]) for _ in range(rng.randint(1, 900))) for _ in range(60)]
    texts += ["long word " * 6000, "same", "same", "same"]
    rows = [(i if i != 2 else None, t) for i, t in enumerate(texts)] + [(1, "")]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    whole, want = Tokenizer.from_file(PATH), Counter()
    for i, text in rows:
        ids = array("I", whole.encode(text or "", add_special_tokens=False).ids + [0])
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want[(i, piece, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for some in places.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) == one_by_one([r["length"] for r in got], 2048)[0]


def test_no_documents(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
