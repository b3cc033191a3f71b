"""Token ids of whole texts by a public tokenizer, with its words remembered.

A text is cut where a blank follows another character. No token of the two
supported kinds of pre-tokenizer reaches over such a place, so the ids of the
text are those of its pieces, one after the other, and each different piece has
to be encoded once only. A piece is cut by the tokenizer's own pattern and the
library's model gives the ids of each part. Pieces or texts for which that is not
certain (rare white space, names of special tokens, letters that newer Unicode
versions may class otherwise) go through the library's whole encoder.

A worker remembers what it has met in two generations: when the younger one is
full it becomes the older, and what is met again moves up. So the memory is
bounded and frequent pieces stay.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from string import punctuation

import regex
from tokenizers import Tokenizer

# Entries of one generation, of some 200 bytes each.
PIECES, PARTS = 350_000, 200_000

_BLANKS = " \t\n\r\x0b\x0c"
_SIGNS = frozenset(",.;:!?")
# White space that is more than single blanks and line breaks, or two breaks. Where there is none, a sign of it may tell the beginning.
_START = "\r"
_LEADS = (_START, "\n")
_RUNS = ("  ", " \n", "\n ", "\n\n\n", "\t", "\r", "\x0b", "\x0c")
_UNIT = re.compile(f"[{_BLANKS}]*[^{_BLANKS}]+|[{_BLANKS}]+")
# White space beyond the blanks, which a pattern may run together with them.
_ODD_SPACE = re.compile("[" + "".join(map(chr, (
    *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")
# Characters whose class and lower case are the same in all Unicode versions in use:
# Latin, Greek and Cyrillic letters, without the sigmas, and the common punctuation.
_SETTLED = re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in (
    (0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0x2AF), (0x391, 0x3A1), (0x3A4, 0x3A9), (0x3B1, 0x3C1), (0x3C4, 0x3C9), (0x410, 0x44F),
    (0x2010, 0x2027), (0x2030, 0x205E), (0x20AC, 0x20AC))) + "]*")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it prints, else one beyond Latin-1."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return {b: chr(b) if b in prints else chr(next(other)) for b in range(256)}


class _Remembered(dict):
    """``make`` of a key, kept for two generations of ``size`` keys."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.make(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = ids
        return ids


class Encoder:
    """``Encoder(path).ids(text)``: the ids as packed little-endian 32-bit integers."""

    def __init__(self, path: str, pieces: int = PIECES, parts: int = PARTS):
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        names = [s["type"] for s in steps]
        split = next((s["pattern"]["Regex"] for s in steps if s["type"] == "Split"), None)
        self.drops_blanks = names == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        own = names == ["ByteLevel"] and steps[0]["use_regex"] and not steps[0]["add_prefix_space"]
        normal = spec["normalizer"] and [n["type"] for n in spec["normalizer"].get("normalizers", [spec["normalizer"]])]
        # What these normalizers do to settled characters is to lower-case them.
        self.lowers = normal == ["NFC", "Replace", "Lowercase"]
        self.fast = spec["model"]["type"] == "BPE" and (self.drops_blanks and self.lowers or own and normal is None)
        # Fixed value: the pattern of the byte-level pre-tokenizer, which its file does not spell out.
        pattern = split if self.drops_blanks else (
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.pattern = regex.compile(pattern)
        # How special tokens begin; a text with such a place is left to the library.
        self.special = {t["content"][:2] for t in spec["added_tokens"]}
        self.model, self.letters = self.whole.model, _byte_letters()
        # Where blanks are kept, parts are pieces too, and most need no entry of their own.
        self.parts = _Remembered(self.part if self.drops_blanks else self.spaced, parts)
        self.pieces = _Remembered(self.word if self.drops_blanks else self.after, pieces)

    def _encoded(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def part(self, part: str) -> bytes:
        """Ids of one part, by the model of the library."""
        if part.isascii() and part.isprintable():
            return self.spelled(part.replace(" ", self.letters[0x20]))
        return self.spelled(part.encode().decode("latin-1").translate(self.letters))

    def spelled(self, letters: str) -> bytes:
        """Ids of one part whose bytes are spelled as letters."""
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def word(self, piece: bytes) -> bytes:
        """Ids of a piece without blanks, for tokenizers that drop them and lower-case."""
        text = piece.decode()
        if not (text.isascii() and text.isprintable() or _SETTLED.fullmatch(text)):
            return self._encoded(text)
        text = text.lower()
        # A word, or a word and one sign after it, needs no pattern.
        if text.isalpha():
            return self.parts[text]
        if text[-1] in _SIGNS and text[:-1].isalpha():
            return self.parts[text[:-1]] + self.parts[text[-1]]
        return b"".join(map(self.parts.__getitem__, self.pattern.findall(text)))

    def spaced(self, text: str) -> bytes:
        """Ids of a piece with the blanks before it, for tokenizers that keep them."""
        body = text.lstrip(_BLANKS)
        if not (body.isascii() and body.isprintable() or _SETTLED.fullmatch(body)):
            return self._encoded(text)
        if len(text) - len(body) <= text.startswith(" "):
            if body.isalpha():
                return self.part(text)
            if body[-1:] in _SIGNS and body[:-1].isalpha():
                return (self.parts[text[:-1]] if text == body else self.pieces[body[:-1]]) + self.parts[body[-1]]
        found = self.pattern.findall(text)
        return self.part(text) if len(found) == 1 else b"".join(map(self.parts.__getitem__, found))

    def after(self, piece: str) -> bytes:
        """Ids of a piece as ``_laid`` cuts it: with one blank before it, or a line break, or at the beginning of a text."""
        if piece.isascii() and piece.isalpha():
            return self.spelled(self.letters[0x20] + piece)
        lead = piece[:1] if piece[:1] in _LEADS else ""
        body = piece[len(lead):]
        # Most other pieces are words with a line break before them or signs after them, which are parts of the pattern.
        word = body.rstrip(punctuation)
        if not (word.isalpha() and (plain := word.isascii() or _SETTLED.fullmatch(word))):
            return self.spaced(body if lead == _START else piece if lead else " " + piece)
        # A word that is known without its signs is not encoded again, but gets no entry of its own.
        ids = None if lead or word == body else self.pieces.get(word) or self.pieces.older.get(word)
        if ids is None:
            letters = word if plain is True else word.encode().decode("latin-1").translate(self.letters)
            ids = self.spelled(letters if lead else self.letters[0x20] + letters)
        if word != body:
            ids += self.parts[body[len(word):]]
        return self.parts[lead] + ids if lead == "\n" else ids

    def ids(self, text: str) -> bytes:
        if not self.fast or any(s in text for s in self.special) or (not self.drops_blanks and _ODD_SPACE.search(text)):
            return self._encoded(text)
        if self.drops_blanks:
            return b"".join(map(self.pieces.__getitem__, text.encode().split()))
        laid = _laid(text)
        if laid is None:
            return b"".join(map(self.parts.__getitem__, _UNIT.findall(text)))
        return b"".join(map(self.pieces.__getitem__, laid.split(" ")))


def _laid(text: str) -> str | None:
    """A text whose pieces are what lies between blanks, for ``Encoder.after``; none where white space comes in runs.

    Alone, a blank goes with what follows, and up to two line breaks stand for themselves.
    """
    if not text or text.endswith("\n\n") or any(run in text for run in _RUNS):
        return None
    laid = text.replace("\n", " \n")
    return laid[1:] if laid[0] == " " else _START + laid


@lru_cache(maxsize=2)
def encoder(path: str, pieces: int = PIECES, parts: int = PARTS) -> Encoder:
    """The encoder of a file; a worker process builds it once and keeps what it has learned."""
    return Encoder(path, pieces, parts)
