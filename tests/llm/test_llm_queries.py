"""The registered queries without SQL, and the pipeline, against plain versions on the smallest tables."""

import hashlib
import zlib
from array import array
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest
import public_tokenizers
from helpers import base_spans, classes, hits, one_by_one, repeat_words, simhash, words
from tokenizers import Tokenizer

import corpus_pipeline
from paddock.llm import queries, secret_scan

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not there")


def _table(name, columns, order):
    return duckdb.sql(f"select {columns} from '{FOLDER}/{name}.parquet' order by {order}").fetchall()


@pytest.fixture(scope="module")
def docs():
    return _table("documents", "doc_id, text", "doc_id")


def _ids(name, text):
    path = public_tokenizers.path(name)
    if name not in _ids.known:
        _ids.known[name] = Tokenizer.from_file(path)
    return array("I", _ids.known[name].encode(text or "", add_special_tokens=False).ids + [0])


_ids.known = {}


def _pieces(docs):
    return {(i, p, p * 2048, len(part), zlib.crc32(part.tobytes())) for i, t in docs
            for ids in [_ids("word_bpe_49k.json", t)] for p in range(-(-len(ids) // 2048)) for part in [ids[p * 2048:p * 2048 + 2048]]}


def _check_packing(rows, docs):
    assert {tuple(r)[:5] for r in rows} == _pieces(docs) and len(rows) == len(_pieces(docs))
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for some in places.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) == one_by_one([r["length"] for r in rows], 2048)[0]


def test_every_operator_has_one_query():
    names = Counter(n.split("_")[0] for n in queries.QUERIES)
    assert names == {f"op{n}": 1 for n in range(1, 14)}


def test_op3(spark, docs):
    prints = [simhash(t) for _, t in docs]
    want = sorted((i, f"{p:016x}", c) for (i, _), p, c in zip(docs, prints, classes(prints, [i for i, _ in docs])))
    assert sorted(tuple(r) for r in queries.QUERIES["op3_simhash"](spark, str(FOLDER)).collect()) == want


def test_op4(spark, docs):
    _check_packing(queries.QUERIES["op4_best_fit_packing"](spark, str(FOLDER)).collect(), docs)


def test_op5(spark, docs):
    want, at = [], 0
    for i, text in docs:
        ids = _ids("byte_bpe_50k.json", text)
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in queries.QUERIES["op5_bit_planes"](spark, str(FOLDER)).collect()) == want


def test_op8(spark, docs):
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_secret_scan"](spark, str(FOLDER)).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        spans, r = base_spans(text), got[i]
        written = [f"{k}:{a}:{b}" for a, _, k, b in spans]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert r["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r["spans"].split(","))


def _kept(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    n, chars = len(w), sum(map(len, w))
    return not (n < 50 or 100 * repeat_words(text) > 50 * n or 10 * sum(text.count(s) for s in "#*$%&|<>") > n
                or 100 * (len(lines) - len(set(lines))) > 40 * len(lines) or chars < 3 * n or chars > 10 * n)


def _stages(docs):
    """What is left after each stage but the last, with masks for base spans only."""
    one = [(i, t) for i, t in docs if _kept(t)]
    prints = [simhash(t) for _, t in one]
    two = [(i, t) for (i, t), c in zip(one, classes(prints, [i for i, _ in one])) if i == c]
    items = _table("benchmark", "item_id, text", "item_id")
    three = [(i, t) for i, t in two if not hits(t, items)[1]]
    return one, two, three


def _mask(text, spans):
    at, out = 0, ""
    for start, _, _, stop in spans:
        if start >= at:
            out += text[at:start] + "[secret]"
        at = max(at, stop)
    return out + text[at:]


def test_pipeline_stages_and_result(spark, docs):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    known = {r["doc_id"]: r for r in frame.collect()}
    want = _stages(docs)
    now = frame
    for (name, stage), left in zip(corpus_pipeline.STAGES[:3], want):
        now = stage(spark, now, str(FOLDER))
        rows = now.collect()
        assert now.columns == frame.columns
        assert sorted(r["doc_id"] for r in rows) == [i for i, _ in left], name
        assert all(r == known[r["doc_id"]] for r in rows)
        now = spark.createDataFrame(rows, frame.schema)
    masked = corpus_pipeline.STAGES[3][1](spark, now, str(FOLDER))
    assert masked.columns == frame.columns
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secret_scan.scan(now.select("doc_id", "text")).collect()}
    texts = [(i, _mask(t, found[i])) for i, t in want[2]]
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in masked.collect()) == [
        (i, t, len(t) if t != known[i]["text"] else known[i]["n_chars"]) for i, t in texts]
    _check_packing(corpus_pipeline.run(spark, str(FOLDER)).collect(), texts)


def test_pipeline_with_odd_rows(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "w " * 200_000, None, "s", None)]
    now = spark.createDataFrame(odd, frame.schema).unionByName(frame.limit(20).unionByName(frame.limit(20)))
    for rows in (now, now.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, str(FOLDER))
            out.count()
