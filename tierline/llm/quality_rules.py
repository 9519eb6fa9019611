"""Quality rules as a bitmask ledger (native: DataFrame operations only).

``ledger`` measures every document once and stores the measurements together
with one bit per rule (set: the rule fails). A policy is a version with the
set of rules it enforces; its verdict is ``failed & mask = 0``, so a new
policy, or an ablation of an old one, reads two narrow columns and never a text.

A text is read once. Repeated five-word windows are found by sorting the
window hashes of a text with their positions (n log n, inside the row).

Defined results: a null text has no words (all measurements 0, it fails the
word count); a text of one very long word is one word; rows are independent,
so repeats and ties change nothing; an empty table gives an empty ledger;
columns beyond id and text are ignored whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.shared import SPACES, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """A condition on the measurements that holds for documents which fail."""
    name: str
    fails: str


# The bit of a rule is its place in this list; places are never reused, new rules go to the end.
RULES = (
    Rule("too_few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 25 * n_words"),
    Rule("symbols", "n_symbols > n_words"),
    Rule("repeated_lines", "n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines"),
)
BASE = ("too_few_words", "repeated_words")
# Versioned policies: the rules each enforces.
POLICIES = {
    "base": BASE,
    "v1": tuple(r.name for r in RULES),
}


def bit(rule: str) -> int:
    return 1 << [r.name for r in RULES].index(rule)


def mask(rules) -> int:
    return sum(bit(r) for r in set(rules))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements) of every document."""
    text = F.coalesce(docs[text_col], F.lit(""))
    df = docs.select(docs[id_col].alias("id"), text.alias("text")).withColumns({
        "w": words(F.col("text")),
        "lines": F.filter(F.split("text", "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0),
        "word_chars": F.length(F.translate("text", SPACES, "")).cast("long"),
        "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
    })
    df = df.withColumns({
        "n_words": F.size("w").cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "windows": F.when(F.size("w") >= WINDOW, F.transform(
            F.slice("w", F.lit(1), F.size("w") - (WINDOW - 1)),
            lambda _, i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]))),
    })
    # Most texts repeat nothing; the others sort (hash, position) pairs: a window is repeated if it equals a neighbour.
    pairs = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("pairs", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), pairs))
    hit = F.filter("pairs", lambda p, k: (p["h"] == F.get(F.col("pairs"), k - 1)["h"]).eqNullSafe(F.lit(True))
                   | (p["h"] == F.get(F.col("pairs"), k + 1)["h"]).eqNullSafe(F.lit(True)))
    df = df.withColumn("at", F.array_sort(F.transform(hit, lambda p: p["i"])))
    # A repeated window adds the words up to the next one's start, five at most.
    covered = F.aggregate(F.transform("at", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("at"), k + 1) - i, F.lit(WINDOW)))),
                          F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).select("id", *MEASURES)


def failures(rules=RULES) -> Column:
    """The bits of the rules that fail."""
    out = F.lit(0)
    for k, r in enumerate(rules):
        out = out.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << k)).otherwise(F.lit(0)))
    return out


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, measurements, failed): every rule evaluated once."""
    return measured(docs, id_col, text_col).withColumn("failed", failures()).withColumnRenamed("id", id_col)


def passes(policy: str) -> Column:
    """The verdict of a policy on a ledger row."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablation(book: DataFrame, policies=tuple(POLICIES)) -> DataFrame:
    """(policy, without, kept): documents each policy keeps as it is (without: null) and with one rule left out.

    The ledger is first counted by its failure bits (2 ** rules rows at most);
    the masks are applied to those counts.
    """
    by_bits = book.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = [(p, r, mask(POLICIES[p]) & ~(bit(r) if r else 0)) for p in policies for r in (None, *POLICIES[p])]
    kept = [F.coalesce(F.sum(F.when(F.col("failed").bitwiseAND(F.lit(m)) == 0, F.col("n"))), F.lit(0)).alias(f"k{i}")
            for i, (_, _, m) in enumerate(cases)]
    rows = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).cast("string").alias("without"), F.col(f"k{i}").alias("kept"))
                     for i, (p, r, _) in enumerate(cases)])
    return by_bits.agg(*kept).select(F.inline(rows))


def verdicts(docs: DataFrame, policy: str = "v1", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its measurements, ``base_failed``, and ``kept`` under ``policy``."""
    book = ledger(docs, id_col, text_col)
    return book.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed",
                       (~passes("base")).alias("base_failed"), (passes("base") & passes(policy)).alias("kept"))
