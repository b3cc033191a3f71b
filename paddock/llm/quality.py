"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and
one failure bit per rule; a policy is a versioned set of rules that count, so a
new policy is a mask over a stored ledger and needs no second look at the texts.
Ablations come from the masks alone.

Everything is built of column functions: one projection per document row, no
shuffle, so a hot source or a very long text stays in the task that read it.

Defined cases: a missing or empty text has no words and fails ``short``; columns
of the input are kept as they are unless the ledger has one of the same name,
which then replaces it; repeated rows are judged one by one; no rows, no result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.exprs import BLANK, let, words_of

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
# The blanks between words.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

# Rule name -> SQL condition over the measures that a document fails on. The bit
# of a rule is its place here, so new rules go to the end.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 40 * n_lines",
    "word_length": "n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words)",
}


@dataclass(frozen=True)
class Policy:
    """A version and the rules whose failure rejects a document."""

    version: str
    rules: tuple[str, ...]

    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


POLICIES = {p.version: p for p in (
    Policy("base", ("short", "repeats")),
    Policy("v1", tuple(RULES)),
)}


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more, each word once."""
    def windows(w):
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(at, lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def same(w, i, j):
        return (w[i] == w[j]) & (w[i + 1] == w[j + 1]) & (w[i + 2] == w[j + 2])

    def starts(w, h):
        """Places of repeated windows: neighbours in hash order with equal words."""
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twin(s, k, other):
            return F.coalesce((s[k]["h"] == s[other]["h"]) & same(w, s[k]["i"], s[other]["i"]), F.lit(False))

        def repeated(s):
            last = F.size(s) - 1
            kept = F.filter(F.sequence(F.lit(0), last), lambda k: (
                F.when(k > 0, twin(s, k, k - 1)).otherwise(False)
                | F.when(k < last, twin(s, k, k + 1)).otherwise(False)))
            return F.sort_array(F.transform(kept, lambda k: s[k]["i"]))

        return let(ordered, repeated)

    def covered(p):
        steps = F.zip_with(F.slice(p, F.lit(2), F.size(p) - 1), F.slice(p, F.lit(1), F.size(p) - 1),
                           lambda b, a: F.least(b - a, F.lit(3)).cast("long"))
        return F.when(F.size(p) == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(3).cast("long"), lambda s, x: s + x))

    def count(w):
        found = let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(starts(w, h), covered)))
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(found)

    return let(words, count).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of every whole text."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike("[^" + BLANK[1:]))
    found = {
        "_words": words_of(body),
        "_lines": lines,
        "word_chars": F.length(F.translate(body, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
    }
    taken = docs.drop(*found, *MEASURES).withColumns(found)
    return taken.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("_words")),
    }).drop("_words", "_lines")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures and ``failed``, one bit per rule of ``RULES``."""
    bits = [F.when(F.expr(rule), F.lit(1 << bit)).otherwise(0).cast("long") for bit, rule in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs, text).withColumn("failed", failed)


def decide(entries: DataFrame, policy: Policy, name: str = "kept") -> DataFrame:
    """A ledger with the verdict of one policy; no rule is evaluated again."""
    return entries.withColumn(name, F.col("failed").bitwiseAND(F.lit(policy.mask())) == 0)


def passing(docs: DataFrame, policy: Policy, text: str = "text") -> DataFrame:
    """The rows of ``docs`` a policy keeps, with the columns they have."""
    entries = ledger(docs.select(F.struct("*").alias("_row"), F.col(text)), text)
    return decide(entries, policy, "_kept").where("_kept").select("_row.*")


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """(rule, failing, only_this, kept_without) of a policy, one row per rule of it.

    The ledger is counted per distinct mask first, of which there are at most
    2 ** rules; the bits are then compared on those few rows.
    """
    masks = entries.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask())).alias("mask")).agg(
        F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << list(RULES).index(r)).cast("long").alias("bit"))
                      for r in policy.rules])
    each = masks.select("mask", "n", F.explode(rules).alias("r")).select("mask", "n", "r.*")
    hit = F.col("mask").bitwiseAND(F.col("bit")) != 0
    alone = F.col("mask") == F.col("bit")
    clear = F.col("mask").bitwiseAND(F.bitwise_not("bit")) == 0
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("failing"),
        F.coalesce(F.sum(F.when(alone, F.col("n"))), F.lit(0)).alias("only_this"),
        F.coalesce(F.sum(F.when(clear, F.col("n"))), F.lit(0)).alias("kept_without"))
