"""Quality rules: measured once, kept as bits, judged by versioned policies."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.llm.shared import BLANKS, bind, whole_text, words_of

WINDOW = 8
SYMBOLS = r"[^#*$%&|<>]+"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_echo_words",
    "n_lines", "n_upper",
)

# Each rule is a bit of the ledger; a rule keeps its bit for good.
RULES: dict[str, tuple[int, str]] = {
    "few_words": (0, "n_words < 20"),
    "repeated_windows": (1, "100 * n_repeat_words > 30 * n_words"),
    "many_symbols": (2, "n_symbols > 20 AND 100 * n_symbols > 15 * n_words"),
    "repeated_lines": (3, "n_dup_lines > 3 AND 100 * n_dup_lines > 50 * n_lines"),
    "long_words": (4, "word_chars > 15 * n_words"),
    "short_words": (5, "word_chars < 2 * n_words"),
    "shouting": (6, "100 * n_upper > 40 * word_chars"),
    "echoing": (7, "n_echo_words > 5 AND 100 * n_echo_words > 20 * n_words"),
}


@dataclass(frozen=True)
class Policy:
    """The rules of which none may fail."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES[r][0] for r in self.rules)


BASE = Policy(1, ("few_words", "repeated_windows"))
PRODUCTION = Policy(2, tuple(RULES))


def _covered(words: Column, windows: Column) -> Column:
    """How many words lie in windows that occur twice or more; ``windows`` are hashes by place.

    Windows of equal hash are compared word by word.
    """

    def places_of(found: Column) -> Column:
        def repeats(x: Column, i: Column) -> Column:
            def same(other: Column) -> Column:
                first = F.slice(words, x["at"] + 1, WINDOW)
                return (other["hash"] == x["hash"]) & (
                    F.slice(words, other["at"] + 1, WINDOW) == first
                )

            near = F.coalesce(same(F.get(found, i - 1)), F.lit(False))
            return near | F.coalesce(same(F.get(found, i + 1)), F.lit(False))

        return F.sort_array(F.transform(F.filter(found, repeats), lambda x: x["at"]))

    def spread(at: Column) -> Column:
        steps = F.transform(
            at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    return bind(F.sort_array(pairs), lambda found: bind(places_of(found), spread))


def _repeat_words(words: Column) -> Column:
    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def counted(windows: Column) -> Column:
        alike = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(alike, F.lit(0)).otherwise(_covered(words, windows))

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(bind(hashes, counted))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures, all from one pass over each whole text."""
    whole = whole_text(text)
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.length(F.regexp_replace(x, BLANKS, "")) > 0)

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            _repeat_words(words).cast("bigint").alias("n_repeat_words"),
            F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))).cast("bigint").alias(
                "n_echo_words"
            ),
        )

    def of_lines(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("bigint").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("bigint").alias("n_dup_lines"),
        )

    both = docs.withColumns({
        "__words": bind(words_of(whole), of_words),
        "__lines": bind(lines, of_lines),
        "n_symbols": F.length(F.regexp_replace(whole, SYMBOLS, "")).cast("bigint"),
        "n_upper": F.length(F.regexp_replace(whole, "[^A-Z]+", "")).cast("bigint"),
    })
    of_all = {"__words": ("n_words", "word_chars", "n_repeat_words", "n_echo_words"),
              "__lines": ("n_lines", "n_dup_lines")}
    from_structs = {m: F.col(f"{part}.{m}") for part, names in of_all.items() for m in names}
    return both.withColumns(from_structs).drop("__words", "__lines")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures and ``failed``, a bit for each rule that the text fails.

    Columns named like a measure or ``failed`` are replaced. A null text is an
    empty one: it has no words and fails ``few_words``. Every row is judged on
    its own, so repeated rows have equal bits, and an empty table gives none.
    """
    bits = [
        F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0))
        for bit, condition in RULES.values()
    ]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured(docs, text).withColumn("failed", failed.cast("bigint"))


def passes(policy: Policy) -> Column:
    """Whether a row of the ledger fails none of the policy's rules."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policies(entries: DataFrame, policies: Mapping[str, Policy]) -> DataFrame:
    """The ledger with a boolean column for each policy; no text is read again."""
    return entries.withColumns({name: passes(p) for name, p in policies.items()})


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: ``rule``, ``fails`` it, ``only`` it, and ``kept`` without it.

    Rows are first counted by their bits, so the rules meet at most one row
    for each combination of bits.
    """
    masked = F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("bits")
    seen = entries.groupBy(masked).agg(F.count(F.lit(1)).alias("rows"))
    rules = F.array(*(
        F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r][0]).cast("bigint").alias("bit"))
        for r in policy.rules
    ))
    each = seen.select("bits", "rows", F.inline(rules))
    count = lambda when: F.sum(F.when(when, F.col("rows")).otherwise(0))
    return each.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("fails"),
        count(F.col("bits") == F.col("bit")).alias("only"),
        count(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept"),
    )
