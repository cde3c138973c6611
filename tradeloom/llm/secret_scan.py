"""Secret scans: fixed patterns, and windows of high entropy inside candidate strings.

Only built-in functions run. A candidate is a maximal run of one character class, as long as a
window or longer. What the allow-list matches in it is left out, the characters before and after
move together, and over them a window slides whose counts are updated by the character that enters
and the one that leaves; from the counts' ``c * log2(c)`` sum follows the window's Shannon entropy.
Windows at or above the class's limit, which is another for candidates without a digit, are merged
into spans of the text as it stands. Spans inside one that a pattern has found already are left out.

Null texts count as empty and give no span; equal rows give equal spans; texts of any length are
scanned whole; other columns are ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import let, text_of

#: Fixed patterns: kind, pattern, the group whose length counts, its least length. A run of access or hex
#: characters that is long enough matches at its start, so those patterns ask for the length themselves.
PATTERNS = (
    ("assign",
     r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)


@dataclass(frozen=True)
class CharacterClass:
    """Characters (as inside a regular expression's brackets), window length, least bits a character.

    ``letters`` are the same characters without the digits, ``letter_bits`` the limit for runs of them alone.
    """

    kind: str
    letters: str
    window: int
    bits: float
    letter_bits: float


#: Six letters have 2.6 bits at most; joined words and paths stay mostly below 3.9, drawn letters are about there.
CLASSES = (
    CharacterClass("entropy_hex", "A-Fa-f", 16, 3.0, 2.3),
    CharacterClass("entropy_base64", "A-Za-z+/_-", 20, 3.7, 3.9),
)

#: Parts of candidates that are no secrets: numbers and dates, UUIDs, placeholders, runs of one character, alphabets.
ALLOWED = (
    r"^[0-9+/_-]*$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"(?i)example|sample|placeholder|dummy|changeme|xxxx",
    r"(.)\1{5}",
    r"(?i)0123456789|abcdefghij",
)


def _found(text: Column, pattern: str, group: int, least: int) -> Column:
    """Spans (start, stop, value) of the pattern's matches whose group has the least length.

    Splitting at the pattern gives what lies between matches, so lengths add up to places. Most
    texts have no match and are searched once only.
    """
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part")),
        lambda gap, m: F.struct(F.char_length(gap).alias("gap"), m["whole"].alias("whole"), m["part"].alias("part")),
    )
    pieces = F.filter(pieces, lambda p: p["whole"].isNotNull())

    def placed(p: Column) -> Column:
        stops = F.aggregate(
            p, F.array().cast("array<int>"),
            lambda a, x: F.array_append(
                a, F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + x["gap"] + F.char_length(x["whole"])))
        spans = F.zip_with(p, stops, lambda x, stop: F.struct(
            (stop - F.char_length(x["whole"])).alias("start"), stop.alias("stop"),
            x["whole"].alias("value"), x["part"].alias("part")))
        return F.transform(
            F.filter(spans, lambda s: F.char_length(s["part"]) >= least),
            lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value")))

    none = F.array().cast("array<struct<start:int,stop:int,value:string>>")
    return F.when(F.rlike(text, F.lit(pattern)), let(pieces, placed)).otherwise(none)


def _blanked(run: Column, rule: str) -> Column:
    """The run with a space for each character that the rule matches."""
    pieces = F.zip_with(
        F.split(run, rule, -1), F.regexp_extract_all(run, F.lit(rule), F.lit(0)),
        lambda gap, m: F.concat(gap, F.repeat(F.lit(" "), F.coalesce(F.char_length(m), F.lit(0)))))
    return F.when(F.rlike(run, F.lit(rule)), F.array_join(pieces, "")).otherwise(run)


def _windows(codes: Column, size: int, bits: Column) -> Column:
    """Merged (start, stop) of the windows of an array of character codes with so many bits or more."""
    powers = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(size + 2)])
    # entropy = log2(size) - sum / size >= bits, with a little room for rounding
    most = (F.lit(math.log2(size)) - bits) * size + 1e-9
    none = F.array().cast("array<struct<start:int,stop:int>>")
    start = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("sum"), none.alias("spans"))

    def changed(state: Column, code: Column, by: int) -> Column:
        held = F.get(state["counts"], code)
        return F.struct(
            F.concat(F.slice(state["counts"], F.lit(1), code), F.array(held + by),
                     F.slice(state["counts"], code + 2, F.lit(127) - code)).alias("counts"),
            (state["sum"] - F.get(powers, held) + F.get(powers, held + by)).alias("sum"),
            state["spans"].alias("spans"))

    def marked(state: Column, stop: Column) -> Column:
        spans, begin = state["spans"], stop - size
        last = F.try_element_at(spans, F.lit(-1))
        longer = F.when(
            last.isNotNull() & (last["stop"] >= begin),
            F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1),
                     F.array(F.struct(last["start"].alias("start"), stop.alias("stop")))),
        ).otherwise(F.array_append(spans, F.struct(begin.alias("start"), stop.alias("stop"))))
        hit = (stop >= size) & (state["sum"] <= most)
        return F.struct(state["counts"].alias("counts"), state["sum"].alias("sum"),
                        F.when(hit, longer).otherwise(spans).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        left = F.when(x["out"].isNull(), state).otherwise(changed(state, x["out"], -1))
        return let(let(left, lambda s: changed(s, x["in"], 1)), lambda s: marked(s, x["at"]))

    moves = F.transform(codes, lambda c, i: F.struct(c.alias("in"), (i + 1).alias("at")))
    leaving = F.concat(F.array_repeat(F.lit(None).cast("int"), size), codes)
    moves = F.zip_with(moves, F.slice(leaving, F.lit(1), F.greatest(F.size(codes), F.lit(1))), lambda m, o: F.struct(
        m["in"].alias("in"), m["at"].alias("at"), o.alias("out")))
    moves = F.filter(moves, lambda m: m["in"].isNotNull())
    return F.aggregate(moves, start, step, lambda s: s["spans"])


def _entropy(text: Column, of: CharacterClass, allowed: Sequence[str]) -> Column:
    """Spans (start, stop) of the class's windows of high entropy."""
    any_of = f"0-9{of.letters}"

    def spans(run: Column) -> Column:
        value = run["value"]
        bits = F.when(F.rlike(value, F.lit("[0-9]")), of.bits).otherwise(of.letter_bits)
        blanked = reduce(lambda v, rule: let(v, lambda x: _blanked(x, rule)), allowed, value)
        left = F.filter(F.transform(F.split(blanked, ""), lambda c, i: F.struct(
            F.ascii(c).alias("code"), (i + run["start"]).alias("at"))), lambda c: c["code"] != 32)
        return let(left, lambda c: F.transform(_windows(c["code"], of.window, bits), lambda w: F.struct(
            F.get(c["at"], w["start"]).alias("start"), (F.get(c["at"], w["stop"] - 1) + 1).alias("stop"))))

    pattern = f"(?<![{any_of}])[{any_of}]{{{of.window},}}+"
    return F.flatten(F.transform(_found(text, pattern, 0, of.window), spans))


def scan_secrets(
    docs: DataFrame, classes: Sequence[CharacterClass] = CLASSES, allowed: Sequence[str] = ALLOWED
) -> DataFrame:
    """One row per document: doc_id, ``base`` and ``added``, arrays of (start, kind_no, stop, kind) in order of start.

    ``base`` has the fixed patterns' matches, ``added`` the windows of high entropy outside of them.
    """
    t = F.col("_text")

    def named(spans: Column, kind: str, number: int) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind_no"), s["stop"].alias("stop"),
            F.lit(kind).alias("kind")))

    base = [named(_found(t, p, g, n), kind, i) for i, (kind, p, g, n) in enumerate(PATTERNS)]
    more = [named(_entropy(t, c, allowed), c.kind, len(PATTERNS) + i) for i, c in enumerate(classes)]
    none = "array<struct<start:int,kind_no:int,stop:int,kind:string>>"
    found = docs.select("doc_id", text_of().alias("_text")).select(
        "doc_id", F.array_sort(F.concat(*base)).alias("base"),
        F.concat(F.array().cast(none), *more).alias("more"))
    outside = let(F.struct("base", "more"), lambda v: F.filter(v["more"], lambda s: ~F.exists(
        v["base"], lambda b: (b["start"] <= s["start"]) & (b["stop"] >= s["stop"]))))
    return found.select("doc_id", "base", F.array_sort(outside).alias("added"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
