"""Quality rules kept as a ledger: every rule is evaluated once, its failures become bits.

:func:`evaluate` measures each document once and stores the failed rules as bits of ``failed``.
Policies are versioned bit masks: a document is kept when it fails no rule of the policy, so a new
version needs no second look at any text. :func:`ablations` finds what each rule does from one
grouped count of the bit patterns. Only built-in functions run.

Words, lines and windows are those of the whole text. Null texts count as empty: no words, so the
rule on length fails. Rows are judged one by one: repeated rows get equal bits, an empty table
gives an empty ledger, other columns of any name are ignored by :func:`evaluate`. Windows of words
are compared by 64-bit hash within one document.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import SPACE, let, text_of, words_of

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words")
#: Words in a window of repeated words.
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A document fails if ``fails``, SQL over the measures, is true. The bit never changes its meaning."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "short_words", "2 * word_chars < 4 * n_words"),
    Rule(5, "long_words", "word_chars > 15 * n_words"),
    Rule(6, "upper_case", "100 * n_upper_words > 60 * n_words"),
)
#: Policy versions: the rules that count.
POLICIES: Mapping[str, Sequence[str]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": tuple(rule.name for rule in RULES),
}
CURRENT = "v2"


def mask_of(policy: str, rules: Sequence[Rule] = RULES) -> int:
    """The bits of a policy's rules."""
    bits = {rule.name: 1 << rule.bit for rule in rules}
    return sum(bits[name] for name in POLICIES[policy])


def _repeated(words: Column, window: int) -> Column:
    """How many words lie in windows that occur twice or more."""
    last = F.size(words) - window + 1

    def covered(starts: Column) -> Column:
        """Words under windows of the given sorted starts."""
        following = F.slice(starts, F.lit(2), F.size(starts))
        gaps = F.zip_with(starts, following, lambda a, b: F.least(F.lit(window), F.coalesce(b - a, F.lit(window))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def starts(keys: Column) -> Column:
        """Sorted starts of the keys that are not alone; equal keys adjoin once sorted."""
        placed = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

        def neighbours(p: Column) -> Column:
            before = F.concat(F.array(F.lit(None).cast("struct<k:bigint,i:int>")), p)
            after = F.slice(p, F.lit(2), F.size(p))
            seen = F.zip_with(F.zip_with(p, after, lambda a, b: F.struct(
                a["i"].alias("i"), a["k"].alias("k"), F.coalesce(a["k"] == b["k"], F.lit(False)).alias("next"))),
                before, lambda a, b: F.struct(
                    a["i"].alias("i"), (a["next"] | F.coalesce(a["k"] == b["k"], F.lit(False))).alias("hit")))
            return F.array_sort(F.transform(F.filter(seen, lambda s: s["hit"]), lambda s: s["i"]))

        return let(placed, neighbours)

    keys = let(words, lambda w: F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(
        F.slice(w, i, F.lit(window)))))
    return F.when(last < 2, F.lit(0)).otherwise(let(keys, lambda k: F.when(
        F.size(F.array_distinct(k)) == F.size(k), F.lit(0)).otherwise(let(starts(k), covered))))


def evaluate(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id") -> DataFrame:
    """The ledger: the key, the measures (long) and ``failed``, a long with a bit for each failed rule."""
    t, w = F.col("_text"), F.col("_words")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    read = docs.select(key, text_of().alias("_text"))
    read = read.withColumns({"_words": words_of(t), "_lines": lines})
    ledger = read.select(
        key,
        F.size(w).alias("n_words"),
        F.char_length(F.array_join(w, "")).alias("word_chars"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        _repeated(w, WINDOW).alias("n_repeat_words"),
        F.size("_lines").alias("n_lines"),
        F.size(F.filter(w, lambda x: (F.upper(x) == x) & (F.lower(x) != x))).alias("n_upper_words"),
    ).select(key, *[F.col(m).cast("long").alias(m) for m in MEASURES])
    bits = sum((F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in rules), F.lit(0))
    return ledger.withColumn("failed", bits.cast("long"))


def passes(policy: str = CURRENT, failed: str = "failed") -> Column:
    """Whether a row of the ledger fails no rule of the policy."""
    return F.col(failed).bitwiseAND(F.lit(mask_of(policy))) == 0


def ablations(ledger: DataFrame, policy: str = CURRENT, rules: Sequence[Rule] = RULES) -> DataFrame:
    """For each rule of the policy: rows that fail it, rows that fail nothing else, rows kept with and without it.

    The ledger is counted by bit pattern first, so at most two to the number of rules rows are left.
    """
    mask = mask_of(policy, rules)
    patterns = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    chosen = [r for r in rules if r.name in POLICIES[policy]]
    counts = [F.struct(
        F.lit(r.name).alias("rule"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.lit(1 << r.bit)) != 0, F.col("n")).otherwise(0)).alias("fail"),
        F.sum(F.when(F.col("bits") == (1 << r.bit), F.col("n")).otherwise(0)).alias("fail_only"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("kept"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.lit(mask & ~(1 << r.bit))) == 0, F.col("n")).otherwise(0))
        .alias("kept_without"),
    ) for r in chosen]
    return patterns.agg(F.array(*counts).alias("r")).select(F.inline("r"))


def filter_quality(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The documents that the policy keeps, all columns as they are."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text_of().alias("text"))
    return evaluate(whole, key="_row").where(passes(policy)).select("_row.*")
