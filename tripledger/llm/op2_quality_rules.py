"""Quality rules as a bitmask ledger.

Every rule is evaluated once: ``ledger`` adds one row's measurements and
``fail_bits``, in which bit k says that rule k failed.  Policies are named,
versioned sets of rules applied to the ledger afterwards (``apply_policy``),
and ``ablation`` tells, from one count over distinct bit patterns, how many
documents each rule of a policy rejects, alone or at all.  DataFrame functions
only; no shuffle but that of the small ablation count.

Defined results: NULL or empty text has no words, all measures 0 and fails
``few_words``; NULL doc_id is carried through; repeated rows and ties are
judged one by one; an empty table gives an empty ledger; other columns of the
input are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.llm import frames

SPACES = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

# Names of the rules; a rule's place is its bit in fail_bits.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "duplicate_lines": "n_dup_lines >= 3 AND 100 * n_dup_lines > 40 * n_lines",
    "short_words": "2 * n_words > word_chars",
    "long_words": "word_chars > 40 * n_words",
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of the filter: the rules whose failure rejects a document."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STANDARD = Policy("standard", 1, tuple(RULES))


def _repeated_words() -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Each window is one 64-bit value: the hash of its words above, its place
    below, so one primitive sort brings equal windows together in order of
    place.  Neighbours with equal upper bits are compared word by word.  The
    covered words are then the gaps between flagged places, at most 3 each.
    """
    flagged = F.filter("packed", lambda x, i: _same(x, i, -1) | _same(x, i, 1))
    places = F.sort_array(F.transform(flagged, lambda x: x.bitwiseAND(F.col("low"))))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("at")),
        lambda acc, p: F.struct(
            (acc["n"] + F.least(F.lit(3).cast("long"), p - acc["at"])).alias("n"), p.alias("at")),
        lambda acc: acc["n"])
    return F.when(F.size("packed") > 1, covered).otherwise(F.lit(0).cast("long"))


def _same(x: Column, i: Column, step: int) -> Column:
    other = F.get(F.col("packed"), i + step)
    at, there = x.bitwiseAND(F.col("low")).cast("int"), other.bitwiseAND(F.col("low")).cast("int")
    alike = (F.bitwise_not(F.col("low")).bitwiseAND(x)
             == F.bitwise_not(F.col("low")).bitwiseAND(other))
    for k in range(3):
        alike &= F.get(F.col("words"), at + k) == F.get(F.col("words"), there + k)
    return F.coalesce(alike, F.lit(False))


def ledger(documents: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, measurements and ``fail_bits`` of every row.

    With ``carry`` the row as given comes along as the struct ``carried``.
    """
    zero = F.lit(0).cast("long")
    whole = [frames.whole_row(documents.columns).alias("carried")] if carry else []
    carried = ["carried"] if carry else []
    split = (
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *whole)
        .select(
            "doc_id", "text", *carried,
            F.filter(F.split("text", SPACES), lambda w: w != "").alias("words"),
            F.filter(F.split("text", "\n"), lambda line: line.rlike(A_WORD)).alias("lines"))
    )
    # The window's place takes as many low bits as the word count needs.
    packed = (
        split.withColumn("n_words", F.size("words").cast("long"))
        .withColumn("low", F.expr("shiftleft(1L, CAST(ceil(log2(n_words + 2)) AS INT)) - 1"))
        .withColumn("packed", F.when(
            F.col("n_words") >= 3,
            F.sort_array(F.transform(
                F.sequence(F.lit(0), F.size("words") - 3),
                lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1),
                                     F.get("words", i + 2))
                .bitwiseAND(F.bitwise_not(F.col("low"))).bitwiseOR(i.cast("long")))))
            .otherwise(F.array().cast("array<long>")))
    )
    # The measures leave through a generator, so that a later filter on them is
    # not written out over the arrays below and evaluated once per use.
    measured = packed.select("doc_id", *carried, F.inline(F.array(F.struct(
        "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words().alias("n_repeat_words")))))
    bits = [F.when(F.expr(test), F.lit(BIT[name]).cast("long")).otherwise(zero)
            for name, test in RULES.items()]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("fail_bits", total)


def failed(policy: Policy) -> Column:
    """Whether a ledger row fails any rule of ``policy``."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(rows: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The ledger with ``base_failed`` and the policy's ``kept``."""
    return rows.withColumns({
        "base_failed": failed(BASE),
        "kept": ~failed(BASE) & ~failed(policy),
        "policy": F.lit(f"{policy.name}-v{policy.version}"),
    })


def ablation(rows: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """Per rule of ``policy``: rejected, rejected by it alone, kept without it.

    One partial aggregation over the masked bit patterns (at most 2^rules
    rows), then bit tests on those few rows.
    """
    patterns = rows.groupBy(
        F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")
    ).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
        for r in policy.rules])).alias("r")
    return (
        patterns.select("bits", "n", rules)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n"))
                   .otherwise(0)).alias("rejected"),
             F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))
                   .otherwise(0)).alias("rejected_alone"),
             F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0,
                          F.col("n")).otherwise(0)).alias("kept_without"))
    )
