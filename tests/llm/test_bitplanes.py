import zlib
from array import array

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from paddock.llm import bitplanes
from paddock.llm.tokens import Encoder, encoder
from paddock.session import workspace

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "  ", " \n\n a  b c  ", "<|endoftext|> hi", "don't we'll 12345 !!!\t\tx", "\u00e9 a\u0327\u0301 \U0001F600", "a\u00a0 b", "x\x1c y",
       "\u03a3 \u03c3\u03c2 \u0130", "a\x00b \ufeff", "\u3000 \u2003x", "x" * 3000, "  lead", "trail  "]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_remembered_pieces_give_the_library_s_ids(name):
    path = public_tokenizers.path(name)
    own, whole = Encoder(path), Tokenizer.from_file(path)
    assert own.fast
    for text in ODD + [" ".join(ODD)]:
        assert array("I", own.ids(text)).tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_words_of_a_text_are_remembered_once():
    own, whole = Encoder(PATH), Tokenizer.from_file(PATH)
    words = ["".join(chr(97 + (n >> k) % 26) for k in (0, 3, 6, 9)) for n in range(300)]
    text = " ".join(words) + "\n" + ", ".join(words) + "."
    assert array("I", own.ids(text)).tolist() == whole.encode(text, add_special_tokens=False).ids
    # A word after a blank, a word with a sign, and what stands at the beginnings of lines; a word is not kept as a part as well.
    assert len(own.parts) < 10 and len(own.pieces) <= 2 * len(set(words)) + 10
    for text in ("a\n\nb", "a\n\n\nb", "\n\na b", " a", "a ", "a \nb", "a\n b", "a  b", "a\n", "a\n\n", "\n", " ", "\ra", "a\tb c", "x, y.", "é, è", "'s 's", "don't I'll"):
        assert array("I", own.ids(text)).tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_a_word_with_signs_takes_one_entry():
    own, whole = Encoder(PATH), Tokenizer.from_file(PATH)
    words = ["".join(chr(97 + (n >> k) % 26) for k in (0, 3, 6, 9)) + "é" * (n % 3) for n in range(300)]
    signs = [",", ".", "%%%", ",###", "'", "_)", "'\""]
    text = " ".join(w + signs[n % len(signs)] for n, w in enumerate(words)) + "\n" + " \n".join(words)
    text = text.replace(" \n", "\n")
    assert array("I", own.ids(text)).tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(own.pieces) <= 2 * len(set(words)) + 10 and len(own.parts) <= len(signs) + 10


@pytest.mark.parametrize("planes", bitplanes.KINDS)
def test_blocks_round_trip(planes):
    rng = np.random.default_rng(2)
    for ids in (rng.integers(0, 50_257, 1000), np.zeros(17), rng.integers(0, 2**32, 1001), np.array([5]), np.array([])):
        assert bitplanes.decode_block(bitplanes.encode_block(ids.astype("<u4"), planes)).tolist() == ids.tolist()


@pytest.mark.parametrize("planes,block", [("byte", 64), ("bit", 16), ("byte", bitplanes.BLOCK)])
def test_files_round_trip(spark, planes, block):
    rows = [(100 - i, t) for i, t in enumerate(ODD + ["long text " * 500, None, "b", "a"])] + [(100, "again"), (None, "n")]
    path = workspace(spark, "test-ids")
    bitplanes.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), path, lambda t: encoder(PATH).ids(t), planes=planes, block=block)
    whole, want, at, stream = Tokenizer.from_file(PATH), [], 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = array("I", whole.encode(text or "", add_special_tokens=False).ids + [0])
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
        stream += ids.tolist()
    got = sorted((tuple(r) for r in bitplanes.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    some = {r["position"]: r["id"] for r in bitplanes.read_ids(spark, path, 70, 200).collect()}
    assert some == dict(zip(range(70, 200), stream[70:200]))


def test_no_documents(spark):
    path = workspace(spark, "test-none")
    bitplanes.write_shards(spark.createDataFrame([], "doc_id long, text string"), path, lambda t: b"")
    assert bitplanes.read_documents(spark, path).count() == 0
