"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; its failure sets one bit of ``failed_bits`` beside
the measurements the rules read. A policy is a version name for a set of rules: applying one is
a bitwise AND over the ledger, and ablations (what would be kept without a rule) come from
counting the distinct bit patterns, of which there are at most 2 to the number of rules.

Only Spark SQL functions are used. Defined cases: a null or empty text has no words, so it
fails ``few_words``; repeated rows and null ids are rows like any other; other columns stay
out of the ledger; an empty table gives an empty ledger. All counts are over whole texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import text_or_empty, words

WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measurement columns; true sets bit number ``bit``."""

    bit: int
    name: str
    failed: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "duplicate_lines", "n_lines > 3 AND 100 * n_dup_lines > 40 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule(5, "shouting", "10 * n_bangs > 3 * n_words"),
)
BASE_RULES = ("few_words", "repeated_windows")
# Versions of the policy: which rules a kept document must pass.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "base": BASE_RULES,
    "v1": (*BASE_RULES, "symbols", "duplicate_lines"),
    "v2": tuple(rule.name for rule in RULES),
}
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs")


def mask_of(policy: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    chosen = set(policy)
    if unknown := chosen - {rule.name for rule in rules}:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    return sum(1 << rule.bit for rule in rules if rule.name in chosen)


def _long(column: Column) -> Column:
    return column.cast("long")


def measure(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the measurements of each text.

    n_words, word_chars: words and the code points in them. n_symbols: characters of
    ``#*$%&|<>``. n_lines, n_dup_lines: lines with a word, and those equal to an earlier one.
    n_repeat_words: words inside windows of three words that the text holds twice or more
    (windows are compared by a 64-bit hash). n_bangs: exclamation marks.
    """
    # Each layer names what the next one reads more than once, so that nothing is computed twice.
    named = docs.select(
        *(F.col(name) for name in keep), text_or_empty(text).alias("_text"), words(text_or_empty(text)).alias("_words"),
        F.filter(F.split(text_or_empty(text), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    hashed = named.withColumn("_windows", F.when(
        F.size("_words") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW),
                    lambda i: F.xxhash64(*(F.get(F.col("_words"), i + k) for k in range(WINDOW)))),
    ).otherwise(F.array().cast("array<bigint>")))
    # Only texts in which a window comes back are sorted.
    ordered = hashed.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
    ))

    def repeated(window: Column, k: Column) -> Column:
        around = [F.get(F.col("_sorted"), k + step)["h"] == window["h"] for step in (-1, 1)]
        return F.coalesce(around[0], F.lit(False)) | F.coalesce(around[1], F.lit(False))

    placed = ordered.withColumn(
        "_places", F.array_sort(F.transform(F.filter("_sorted", repeated), lambda window: window["at"])))
    covered = F.aggregate(
        F.transform("_places", lambda at, k: F.least(
            F.lit(WINDOW), at - F.coalesce(F.get(F.col("_places"), k - 1), at - WINDOW))),
        F.lit(0), lambda total, n: total + n,
    )
    return placed.select(
        *(F.col(name) for name in keep),
        _long(F.size("_words")).alias("n_words"),
        _long(F.length(F.regexp_replace("_text", r"[\x20\x09-\x0D]+", ""))).alias("word_chars"),
        _long(F.regexp_count("_text", F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
        _long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        _long(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"),
        _long(F.size("_lines")).alias("n_lines"),
        _long(F.regexp_count("_text", F.lit("!"))).alias("n_bangs"),
    )


def ledger(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), rules: Sequence[Rule] = RULES) -> DataFrame:
    """Measurements and ``failed_bits``: bit ``rule.bit`` is set where the rule fails."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.failed), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, text, keep).withColumn("failed_bits", bits)


def passes(policy: Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    """Whether a row of the ledger fails no rule of the policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask_of(policy, rules)).cast("long")) == 0


def ablation(kept_ledger: DataFrame, policy: Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """For each rule of the policy: rows it fails, rows that fail it alone, rows kept with and without it."""
    mask = mask_of(policy, rules)
    patterns = (kept_ledger.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits"))
                .agg(F.count(F.lit(1)).alias("n")))
    chosen = [rule for rule in rules if rule.name in set(policy)]
    per_rule = patterns.select("bits", "n", F.explode(F.array(*(
        F.struct(F.lit(rule.name).alias("rule"), F.lit(1 << rule.bit).cast("long").alias("mask")) for rule in chosen
    ))).alias("r")).select("bits", "n", "r.rule", "r.mask")
    hit, alone = F.col("bits").bitwiseAND(F.col("mask")) != 0, F.col("bits") == F.col("mask")
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))
    return per_rule.groupBy("rule").agg(
        count(hit).alias("n_failed"), count(alone).alias("n_failed_alone"), count(F.col("bits") == 0).alias("n_kept"),
        count((F.col("bits") == 0) | alone).alias("n_kept_without"),
    )
