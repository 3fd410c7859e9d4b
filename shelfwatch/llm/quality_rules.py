"""Quality rules: a ledger of rule bits per document, and policies over it.

Every rule is evaluated once. The ledger keeps what was measured and one bit per failed rule, so
a policy is a bit mask: applying another version, or asking what a single rule costs, reads the
ledger's bits and no text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import BLANKS, free_names, words_sql

#: rule name -> SQL condition of failure over the measurements; the position is the bit
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 14 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "100 * n_dup_lines > 60 * n_lines",
    "capitals": "100 * n_upper > 50 * word_chars",
    "bullets": "n_lines >= 5 and 100 * n_bullets > 90 * n_lines",
    "cut_lines": "n_lines >= 5 and 100 * n_cut_lines > 30 * n_lines",
}

#: policy version -> rules in force
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": tuple(RULES),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bullets", "n_cut_lines")


def mask(policy: str, policies: dict[str, tuple[str, ...]] = POLICIES) -> int:
    order = list(RULES)
    return sum(1 << order.index(r) for r in policies[policy])


# Positions of 3-word windows that occur twice or more, without leaving the row: equal windows have
# equal hashes, so sorted (hash, position) numbers put them side by side; only those are then
# compared as text. Linear but for the sorts; ``w`` are the words, each step is bound once.
_REPEATED = """
if(size(w) < 4, 0L, cast(transform(array(
  array_sort(transform(sequence(0, size(w) - 3),
    i -> shiftleft(cast(hash(get(w, i), get(w, i + 1), get(w, i + 2)) as bigint), 32) + i))), s ->
  transform(array(filter(s, (x, j) ->
    coalesce(shiftright(x, 32) = shiftright(get(s, j + 1), 32), false)
    or coalesce(shiftright(x, 32) = shiftright(get(s, j - 1), 32), false))), c ->
  if(size(c) = 0, 0, transform(array(
    array_sort(transform(transform(c, x -> cast(x & 4294967295L as int)),
      p -> struct(concat_ws(' ', get(w, p), get(w, p + 1), get(w, p + 2)) as t, p as p)))), t ->
  size(array_distinct(flatten(transform(
    filter(t, (x, j) -> coalesce(x.t = get(t, j + 1).t, false) or coalesce(x.t = get(t, j - 1).t, false)),
    x -> array(x.p, x.p + 1, x.p + 2)))))
  )[0]))[0])[0] as bigint))
"""


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of MEASURES, replacing columns of these names.

    A null text counts as empty: no words, no lines. Lines are ``\\n`` pieces with a word in them.
    A text is never cut; all work stays within its row.
    """
    w, l = free_names([*docs.columns, *MEASURES], "_w", "_l")
    body = f"coalesce(`{text}`, '')"
    lines = f"filter(split({body}, '\\n'), l -> btrim(l, {BLANKS}) != '')"
    return (
        docs.withColumns({w: F.expr(words_sql(f"`{text}`")), l: F.expr(lines)})
        .withColumns(
            {
                "n_words": F.size(w).cast("long"),
                "word_chars": F.expr(f"cast(length(translate({body}, {BLANKS}, '')) as bigint)"),
                "n_symbols": F.expr(f"cast(length({body}) - length(translate({body}, '#*$%&|<>', '')) as bigint)"),
                "n_dup_lines": F.expr(f"cast(size({l}) - size(array_distinct({l})) as bigint)"),
                "n_repeat_words": F.expr(f"transform(array({w}), w -> {_REPEATED})[0]"),
                "n_lines": F.size(l).cast("long"),
                "n_upper": F.expr(f"cast(length({body}) - length(translate({body}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) as bigint)"),
                "n_bullets": F.expr(f"cast(size(filter({l}, l -> substr(btrim(l, {BLANKS}), 1, 1) in ('-', '*', '•'))) as bigint)"),
                "n_cut_lines": F.expr(f"cast(size(filter({l}, l -> endswith(btrim(l, {BLANKS}), '...') or endswith(btrim(l, {BLANKS}), '…'))) as bigint)"),
            }
        )
        .drop(w, l)
    )


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all measurements and ``fail_bits``: bit i is set if rule i of RULES fails."""
    bits = " | ".join(f"if({cond}, {1 << i}L, 0L)" for i, cond in enumerate(RULES.values()))
    return measure(docs, text).withColumn("fail_bits", F.expr(bits))


def apply_policy(rows: DataFrame, policy: str, out: str = "kept") -> DataFrame:
    """``out`` is true where no rule in force failed. ``rows`` is a ledger."""
    return rows.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0)


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy costs: (rule, failed, only, kept, kept_without).

    ``failed`` documents fail the rule, ``only`` fail no other rule in force, ``kept`` pass the
    policy, ``kept_without`` would pass without the rule. The ledger is first reduced to one row
    per bit pattern, at most 2^rules of them; the rest reads those.
    """
    m = mask(policy)
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(m).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    order = list(RULES)
    rules = ", ".join(f"struct('{r}' as rule, {1 << order.index(r)}L as bit)" for r in POLICIES[policy])
    each = patterns.select("bits", "n", F.expr(f"explode(array({rules})) as r")).select("bits", "n", "r.*")

    def total(cond: str, name: str):
        return F.coalesce(F.sum(F.when(F.expr(cond), F.col("n"))), F.lit(0)).alias(name)

    return each.groupBy("rule").agg(
        total("bits & bit != 0", "failed"),
        total("bits = bit", "only"),
        total("bits = 0", "kept"),
        total("bits & ~bit = 0", "kept_without"),
    )
