"""Secrets in texts: fixed patterns, and windows of high entropy.

The patterns give the base spans. On top of them a window slides over candidate
strings of one character class and its Shannon entropy is kept up to date from
the counts of the characters inside: one character enters, one leaves, and the
sum of n * log2(n) changes by their terms alone. Windows that overlap a match of
the allow list are not looked at, the rest of their candidate is; base spans are
never suppressed.

A candidate has both letters and digits: a run of letters alone cannot be told
from a word, and is found behind a keyword only.

All of it is column functions on one row: no shuffle, and a long text or a hot
source stays where it was read. Positions are code points, the end exclusive.

Defined cases: a missing or empty text has no spans; repeated rows are scanned
one by one; other columns are kept, one named ``spans`` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.exprs import let

# The base kinds in their order, pattern, and what a match must have.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 12
# A run that is long enough is the same match as a run of any length that is kept for its length.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BASE_KINDS = ("assign", "access", "hex")

SPAN = "array<struct<start:int,rank:int,kind:string,stop:int>>"


@dataclass(frozen=True)
class CharClass:
    """Candidates of one character class: alphabet, window and least entropy in bits."""

    name: str
    alphabet: str
    window: int
    bits: float
    pattern: str


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("hex_upper", _DIGITS + "ABCDEF", 20, 3.0, r"(?<![0-9A-Za-z])[0-9A-F]{20,}(?![0-9A-Za-z])"),
    CharClass("base64", _LOWER.upper() + _LOWER + _DIGITS + "+/=_-", 24, 3.9,
              r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/=_-]*[0-9])(?=[a-z0-9+/=_-]*[A-Z])(?=[A-Z0-9+/=_-]*[a-z])[A-Za-z0-9+/=_-]{24,}"),
    CharClass("lower36", _DIGITS + _LOWER, 20, 3.4, r"(?<![0-9A-Za-z])(?=[a-z]*+[0-9])(?=[0-9]*+[a-z])[0-9a-z]{20,}(?![0-9A-Za-z])"),
    # Runs that fit hex_upper or base32 are left to them.
    CharClass("upper36", _DIGITS + _LOWER.upper(), 20, 3.4,
              r"(?<![0-9A-Za-z])(?=[0-9A-F]*+[G-Z])(?=[A-Z2-7]*+[0189])[0-9A-Z]{20,}(?![0-9A-Za-z])"),
    CharClass("base32", _LOWER.upper() + "234567", 16, 3.0, r"(?<![0-9A-Za-z])(?=[2-7A-F]*+[G-Z])(?=[A-Z]*+[2-7])[A-Z2-7]{16,}(?![0-9A-Za-z])"),
)
# A run of the alphabet from its start, as far as it goes.
_ALPHABET = "abcdefghij" + "".join(f"(?:{c}" for c in "klmnopqrstuvwxyz") + ")?" * 16
# Parts of candidates that are no secrets: candidates of words joined by signs as a
# whole, runs of the alphabet, ids in the usual grouped form, and documented sample keys.
ALLOWED = (
    r"^(?:[A-Za-z]++[-_/=+]++)*+[A-Za-z]*+[0-9]{0,4}$",
    rf"(?i)0123456789|{_ALPHABET}",
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"(?i)example|sample|placeholder|xxxxx",
)


def _located(text: Column, pattern: str) -> Column:
    """(start, found) of all leftmost non-overlapping matches, in order.

    Splitting at the pattern gives the text between the matches; the lengths of
    both, added up, are the positions.
    """
    step = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                      lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,found:string>>").alias("out"))

    def add(state, x):
        begin = state["at"] + x["gap"]
        return F.struct((begin + F.length(x["hit"])).alias("at"),
                        F.concat(state["out"], F.array(F.struct(begin.alias("start"), x["hit"].alias("found")))).alias("out"))

    matched = F.filter(step, lambda x: x["hit"].isNotNull())
    return F.when(text.rlike(pattern), F.aggregate(matched, first, add, lambda s: s["out"]))


def _span(kind: str, rank: int, begin: Column, stop: Column) -> Column:
    return F.struct(begin.cast("int").alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                    stop.cast("int").alias("stop"))


def _whole_match(kind: str, rank: int):
    return lambda m: _span(kind, rank, m["start"], m["start"] + F.length(m["found"]))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start and then by kind."""
    none = F.array().cast(SPAN)
    parts = []
    for rank, (kind, pattern) in enumerate(zip(BASE_KINDS, (ASSIGN, ACCESS, HEX))):
        found = _located(text, pattern)
        if kind == "assign":
            found = F.filter(found, lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 1)) >= ASSIGN_MIN)
        parts.append(F.coalesce(F.transform(found, _whole_match(kind, rank)), none))
    return F.sort_array(F.concat(*parts))


def _term(n: Column) -> Column:
    """n * log2(n), zero for none."""
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def hottest(candidate: Column, kind: CharClass) -> Column:
    """(first, last) window ends, counted from 1, whose entropy reaches the bound; missing if none.

    The state holds the count of every character of the alphabet in the window
    and the sum of n * log2(n) over them; the entropy is log2(w) - sum / w.
    """
    w, least = kind.window, kind.bits
    letters = F.split(candidate, "(?<=.)(?=.)")
    alphabet = F.lit(kind.alphabet)
    start = F.struct(F.lit(0).alias("at"), F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"),
                     F.lit(0.0).alias("total"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))

    def move(chars):
        def step(s, c):
            enter = F.instr(alphabet, c) - 1
            leave = F.when(s["at"] >= w, F.instr(alphabet, F.get(chars, s["at"] - w)) - 1).otherwise(F.lit(-1))
            gain = let(F.get(s["counts"], enter), lambda n: _term(n + 1) - _term(n))
            loss = let(F.get(s["counts"], leave), lambda n: _term(n) - _term(n - 1))
            total = s["total"] + F.when(enter == leave, F.lit(0.0)).otherwise(gain - F.coalesce(loss, F.lit(0.0)))
            counts = F.transform(s["counts"], lambda n, k: n + (k == enter).cast("int") - (k == leave).cast("int"))
            here = s["at"] + 1

            def close(t):
                over = (here >= w) & (F.lit(float(w)) * (F.log2(F.lit(float(w))) - least) >= t - 1e-9)
                return F.struct(here.alias("at"), counts.alias("counts"), t.alias("total"),
                                F.when(over & s["first"].isNull(), here).otherwise(s["first"]).alias("first"),
                                F.when(over, here).otherwise(s["last"]).alias("last"))

            return let(total, close)

        return F.aggregate(chars, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))

    return let(letters, move)


def _pieces(allowed: tuple[str, ...]):
    """(start, found) of what the allow list leaves of a candidate: a window inside a piece overlaps no match."""
    parts = "|".join(f"(?:{p})" for p in allowed)

    def cut(m):
        step = F.zip_with(F.split(m["found"], parts, -1), F.regexp_extract_all(m["found"], F.lit(parts), F.lit(0)),
                          lambda gap, hit: F.struct(gap.alias("gap"), F.coalesce(F.length(hit), F.lit(0)).alias("hit")))
        first = F.struct(m["start"].alias("at"), F.array().cast("array<struct<start:int,found:string>>").alias("out"))
        return F.aggregate(step, first, lambda s, x: F.struct(
            (s["at"] + F.length(x["gap"]) + x["hit"]).alias("at"),
            F.concat(s["out"], F.array(F.struct(s["at"].alias("start"), x["gap"].alias("found")))).alias("out")), lambda s: s["out"])

    return lambda m: F.when(m["found"].rlike(parts), cut(m)).otherwise(F.array(m))


def _rated(kind: CharClass):
    return lambda m: F.struct(m["start"].alias("start"), hottest(m["found"], kind).alias("hot"))


def _hot_part(kind: CharClass, rank: int):
    return lambda m: _span("entropy_" + kind.name, rank, m["start"] + m["hot"]["first"] - kind.window,
                           m["start"] + m["hot"]["last"])


def entropy_spans(text: Column, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Spans from the first to the last window of high entropy of every candidate."""
    none = F.array().cast(SPAN)
    parts = []
    for place, kind in enumerate(classes):
        found = _located(text, kind.pattern)
        if allowed:
            found = F.flatten(F.transform(found, _pieces(allowed)))
        over = F.filter(F.transform(found, _rated(kind)), lambda m: m["hot"]["first"].isNotNull())
        parts.append(F.coalesce(F.transform(over, _hot_part(kind, len(BASE_KINDS) + place)), none))
    return F.concat(*parts)


def spans_of(text: Column, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Base spans, and entropy spans that lie in none of them, by start and then by kind."""
    body = F.coalesce(text.cast("string"), F.lit(""))

    def joined(base):
        more = F.filter(entropy_spans(body, classes, allowed), lambda e: ~F.exists(
            base, lambda b: (b["start"] <= e["start"]) & (e["stop"] <= b["stop"])))
        return F.sort_array(F.concat(base, more))

    return let(base_spans(body), joined)


def scan(docs: DataFrame, text: str = "text", classes: tuple[CharClass, ...] = CLASSES,
         allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with ``spans``, an array of (start, rank, kind, stop)."""
    return docs.withColumn("spans", spans_of(F.col(text), classes, allowed))


def written(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` whose texts have ``mask`` in the place of every span; overlapping spans become one.

    Other columns stay, and so does a missing text.
    """
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    body = F.col(text).cast("string")

    def cut(state, s):
        gap = F.substring(body, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        fresh = s["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"),
                        F.when(fresh, F.concat(state["out"], F.array(gap, F.lit(mask)))).otherwise(state["out"]).alias("out"))

    done = F.aggregate("_spans", first, cut, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(body, s["at"] + 1, F.length(body))))
    found = docs.withColumn("_spans", spans_of(F.col(text)))
    return found.withColumn(text, F.when(F.size("_spans") > 0, done).otherwise(body)).drop("_spans")
