"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document: its measurements and one failure bit per rule go into a ledger. A policy is
a named, versioned mask of the rules that reject; applying one, or asking what a rule alone costs (an ablation), is bit
arithmetic on the ledger and never reads a text again.

All measurements are whole numbers and rules compare them by multiplication, so nothing depends on rounding. Nothing is
shuffled but the few sums of an ablation.

Defined cases: null and empty texts have no words and fail the rules on length; repeated rows are judged alike; null
ids are kept; an empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.base import WORD_BREAK

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
REPEAT_WIDTH = 5

#: Rule name to the condition under which a document fails it, in ledger columns. A rule's bit is its place here, so
#: rules are only ever added at the end.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 10",
    "repeats_itself": "100 * n_repeat_words > 20 * n_words",
    "words_too_long": "word_chars > 14 * n_words",
    "words_too_short": "word_chars < 2 * n_words",
    "too_many_symbols": "100 * n_symbols > 10 * word_chars",
    "repeats_lines": "100 * n_dup_lines > 30 * n_lines",
    "few_letters": "100 * n_letters < 50 * word_chars",
}
BASE = ("too_few_words", "repeats_itself")


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


@dataclass(frozen=True)
class Policy:
    """A version of what rejects."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(bit(r) for r in self.rules)


BASE_POLICY = Policy("base", 1, BASE)
#: The production verdict: the base rules, and rules that only text which is hardly prose fails.
PROSE_POLICY = Policy("prose", 1, tuple(RULES))


def _count_in(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def ledger(docs: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """One row per document: the id, measurements, and ``failures``, a bit per failed rule.

    n_repeat_words counts words in a five-word window found twice or more in the same text. Windows are compared by a
    64-bit hash: sorted with their positions, equal ones are neighbours, and those positions, in order, each add their
    distance to the one before, at most the window's width. A text whose windows all differ sorts nothing.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    width, last = REPEAT_WIDTH, F.size("words") - REPEAT_WIDTH
    windows = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                          lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(width)]))
    measured = docs.select(
        F.col(f"`{id_}`").alias("id"), body.alias("body"),
        F.filter(F.split(body, WORD_BREAK, -1), lambda w: w != "").alias("words"),
    ).select(
        "id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("body", SPACES, "")).cast("bigint").alias("word_chars"),
        _count_in(F.col("body"), SYMBOLS).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace("body", r"\P{L}+", "")).cast("bigint").alias("n_letters"),
        F.filter(F.split("body", "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0).alias("lines"),
        F.when(last >= 0, windows).otherwise(F.array().cast("array<bigint>")).alias("hashes"),
    ).withColumns({
        "n_lines": F.size("lines").cast("bigint"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        "placed": F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"),
                         F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    }).withColumn(
        "twice", F.expr("""array_sort(transform(
            filter(placed, (x, k) -> x.h = get(placed, k - 1).h OR x.h = get(placed, k + 1).h), x -> x.i))"""),
    ).withColumn(
        "n_repeat_words", F.coalesce(F.expr(f"""aggregate(twice, named_struct('n', 0, 'last', -{width}),
            (a, i) -> named_struct('n', a.n + least({width}, i - a.last), 'last', i), a -> a.n)"""), F.lit(0)).cast("bigint"))
    failed = [F.when(F.expr(condition), F.lit(bit(rule))).otherwise(F.lit(0)) for rule, condition in RULES.items()]
    bits = failed[0]
    for one in failed[1:]:
        bits = bits.bitwiseOR(one)
    return measured.select(F.col("id").alias(id_), "n_words", "word_chars", "n_symbols", "n_letters", "n_lines", "n_dup_lines",
                           "n_repeat_words", bits.alias("failures"))


def judge(policy: Policy) -> Column:
    """Whether a ledger row is kept under a policy."""
    return F.col("failures").bitwiseAND(F.lit(policy.mask)) == 0


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of a policy: failed (documents that fail it), alone (documents only it rejects, kept again without it),
    and kept (documents kept if it were dropped). One aggregate over the ledger, one row per rule.
    """
    hit = F.col("failures").bitwiseAND(F.lit(policy.mask))
    sums = [F.count(F.when(hit == 0, 1)).alias("kept")]
    for i, rule in enumerate(policy.rules):
        sums += [F.count(F.when(hit.bitwiseAND(F.lit(bit(rule))) != 0, 1)).alias(f"f{i}"),
                 F.count(F.when(hit == bit(rule), 1)).alias(f"a{i}")]
    rows = [F.struct(F.lit(rule).alias("rule"), F.col(f"f{i}").alias("failed"), F.col(f"a{i}").alias("alone"),
                     (F.col("kept") + F.col(f"a{i}")).alias("kept")) for i, rule in enumerate(policy.rules)]
    return entries.agg(*sums).select(F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"),
                                     F.inline(F.array(*rows)))
