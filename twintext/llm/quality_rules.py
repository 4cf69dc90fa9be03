"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps what was measured
and one bit per failed rule; policies are bit masks over it, so that changing a
policy, comparing versions or asking what a rule contributes needs no second
pass over the texts. Built-in expressions only.

A null or empty text has no words and no symbols: all measurements are 0, and it
fails ``few_words``. Rows are judged on their own: repeated rows get equal
ledgers, null ids stay null, an empty table gives an empty ledger, and a text is
always measured whole. Other columns of the table are not read, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twintext.llm.common import WHITE, fresh, let, words

WINDOW = 5

#: Bit by position. New rules go to the end, so that stored ledgers stay readable.
RULES = ("few_words", "repeated_windows", "symbols", "exclamation", "repeated_lines", "word_length")

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_exclamations", "n_lines",
)


@dataclass(frozen=True)
class Policy:
    """A version of the quality policy: the rules that reject a document."""

    version: str
    rules: Sequence[str]

    @property
    def mask(self) -> int:
        return sum(1 << RULES.index(r) for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
#: What the query and the pipeline apply.
STANDARD = Policy("standard-1", RULES)


def _failures(m: dict[str, Column]) -> dict[str, Column]:
    """When each rule fails, over the measurements. Integer arithmetic: no rounding at the limits."""
    n = m["n_words"]
    return {
        "few_words": n < 10,
        "repeated_windows": 100 * m["n_repeat_words"] > 20 * n,
        "symbols": 10 * m["n_symbols"] > n,
        "exclamation": 10 * m["n_exclamations"] > 3 * n,
        "repeated_lines": 10 * m["n_dup_lines"] > 3 * m["n_lines"],
        "word_length": (m["word_chars"] < 2 * n) | (m["word_chars"] > 20 * n),
    }


def _covered(hashes: Column) -> Column:
    """Words inside windows that are found twice or more, given the windows' hashes in order.

    Equal hashes become neighbours by sorting; the windows among them are put
    back in order, and each adds the words that the one before did not cover.
    """

    def repeated(pairs: Column) -> Column:
        def twice(x: Column, k: Column) -> Column:
            before, after = F.get(pairs, k - 1)["h"], F.get(pairs, k + 1)["h"]
            return x["h"].eqNullSafe(before) | x["h"].eqNullSafe(after)

        return F.array_sort(F.transform(F.filter(pairs, twice), lambda x: x["i"]))

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        let(pairs, repeated),
        start,
        lambda acc, i: F.struct(
            (acc["sum"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("sum"), i.alias("last")
        ),
        lambda acc: acc["sum"],
    )


def with_ledger(df: DataFrame, text: str, ledger: str) -> DataFrame:
    """Add ``ledger``: a struct of the measurements and ``failed``, the bits of failed rules."""
    found, hashes, lines, measured = fresh(df, "words", "hashes", "lines", "measured")
    columns = [F.col(c) for c in df.columns]
    content = F.coalesce(F.col(text), F.lit(""))
    windows = F.transform(
        F.sequence(F.lit(1), F.size(found) - WINDOW + 1),
        lambda i: F.xxhash64(F.slice(F.col(found), i, WINDOW)),
    )
    worded = F.filter(F.split(content, "\n"), lambda x: x.rlike(f"[^{WHITE}]"))
    length = F.char_length(content)
    repeat = F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _covered(F.col(hashes)))
    values = {
        "n_words": F.size(found),
        "word_chars": F.char_length(F.array_join(found, "")),
        "n_symbols": length - F.char_length(F.regexp_replace(content, "[#*$%&|<>]+", "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(repeat, F.lit(0)),
        "n_exclamations": length - F.char_length(F.replace(content, F.lit("!"), F.lit(""))),
        "n_lines": F.size(lines),
    }
    kept = {m: F.col(measured)[m] for m in MEASURES}
    fails = _failures(kept)
    bits = [F.when(fails[r], F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)]
    failed = sum(bits[1:], bits[0]).cast("long")
    return (
        df.select(*columns, words(F.col(text)).alias(found), worded.alias(lines))
        .select(*columns, found, lines, F.when(F.size(found) >= WINDOW, windows).alias(hashes))
        .select(
            *columns, F.struct(*[values[m].cast("long").alias(m) for m in MEASURES]).alias(measured)
        )
        .select(
            *columns, F.struct(*[kept[m].alias(m) for m in MEASURES], failed.alias("failed")).alias(ledger)
        )
    )


def ledger(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, measurements, failed)``: one row per document, to be stored."""
    (name,) = fresh(df, "ledger")
    return with_ledger(df.select(doc_id, text), text, name).select(doc_id, f"{name}.*")


def passes(failed: Column, policy: Policy) -> Column:
    """Whether a document passes a policy, from its stored bits."""
    return failed.bitwiseAND(F.lit(policy.mask)) == 0


def keep_passing(df: DataFrame, policy: Policy = STANDARD, text: str = "text") -> DataFrame:
    """The documents that pass, unchanged."""
    name, mark = fresh(df, "ledger", "mark")
    # Not a filter: that would be moved below the measurements, with a copy of
    # them in place of every mention. Exploding null gives no row.
    stays = F.when(passes(F.col(f"{name}.failed"), policy), F.array(F.lit(True)))
    judged = with_ledger(df, text, name).select(*df.columns, F.explode(stays).alias(mark))
    return judged.select(*df.columns)


def ablations(stored: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """What each rule of a policy does: ``(version, rule, failing, rejected_only_by, kept_without)``.

    Works on the stored bits: they are first counted by combination, of which
    there are at most ``2 ** len(RULES)`` whatever the number of documents.
    """
    masked = F.col("failed").bitwiseAND(F.lit(policy.mask))
    combos = stored.groupBy(masked.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    per_rule = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES.index(r)).cast("long").alias("bit")) for r in policy.rules]
    )
    # One row even for an empty ledger, so that every rule is reported.
    none = stored.sparkSession.createDataFrame([(0, 0)], "bits long, n long")
    each = combos.union(none).select("bits", "n", F.explode(per_rule).alias("r"))
    has = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    without = F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return each.groupBy(F.lit(policy.version).alias("version"), F.col("r.rule").alias("rule")).agg(
        count(has).alias("failing"),
        count(has & without).alias("rejected_only_by"),
        count(without).alias("kept_without"),
    )


def judged(df: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The ledger with the verdicts of the base rules and of ``policy``."""
    rows = ledger(df)
    base = ~passes(F.col("failed"), BASE)
    return rows.select(
        "doc_id", *MEASURES[:5], base.alias("base_failed"),
        (~base & passes(F.col("failed"), policy)).alias("kept"),
        "n_exclamations", "n_lines", F.col("failed").alias("failed_bits"),
    )
