"""Quality rules as a ledger of bits.

``rule_ledger`` measures a document once and evaluates every rule once; the failures are
the bits of one number. Policies are versions with a mask: a document is kept where no
bit of the mask is set, so a new policy, or the effect of leaving a rule out, needs
only the ledger and never the texts again.

Cases: a null or empty text has no words, lines or symbols (all measures 0) and fails
``few_words`` alone; repeated rows are judged alike, row by row; other columns are
ignored by ``rule_ledger``; an empty table gives an empty ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.llm.common import bind, table

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

#: Rules in the order of their bits: name and condition of failure on the measures.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 20 * n_words",
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}

#: Versions of the policy: the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols"),
    "v2": tuple(RULES),
}
BASE, CURRENT = "base", "v2"


def policy_mask(version: str) -> int:
    return sum(BIT[name] for name in POLICIES[version])


def _windows(words: Column) -> Column:
    """Three-word windows as text; a word holds no space, so no two differ but look alike."""
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    window = lambda i: F.concat_ws(
        " ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)
    )
    return F.when(F.size(words) < 3, F.array().cast("array<string>")).otherwise(
        F.transform(starts, window)
    )


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more.

    Equal windows are neighbours once sorted; the starts of those that have an equal
    neighbour cover three words each, fewer where the next start is nearer.
    """

    def starts(ordered: Column) -> Column:
        same = lambda x, i: F.coalesce(x["t"] == F.get(ordered, i)["t"], F.lit(False))
        repeated = F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return F.array_sort(F.transform(repeated, lambda x: x["i"]))

    def words(at: Column) -> Column:
        gaps = F.transform(
            at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    pairs = F.transform(windows, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    counted = bind(bind(F.sort_array(pairs), starts), words)
    all_differ = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(all_differ, F.lit(0)).otherwise(counted)


def _word_measures(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        bind(_windows(words), _covered).cast("long").alias("n_repeat_words"),
    )


def _line_measures(lines: Column) -> Column:
    return F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    )


def rule_ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measures..., failed) for every row of ``docs`` (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    measured = docs.select(
        "doc_id",
        bind(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), _word_measures).alias("w"),
        bind(lines, _line_measures).alias("l"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
    ).select("doc_id", "w.*", "n_symbols", "l.*")
    bits = [F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)) for name, rule in RULES.items()]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed.cast("long"))


def rejected_by(version: str) -> Column:
    """Whether the policy rejects a row of the ledger."""
    return F.col("failed").bitwiseAND(F.lit(policy_mask(version))) != 0


def apply_policies(ledger: DataFrame, versions=tuple(POLICIES)) -> DataFrame:
    """The ledger with a column ``kept_<version>`` for each version."""
    return ledger.withColumns({f"kept_{v}": ~rejected_by(v) for v in versions})


def ablations(ledger: DataFrame, versions=tuple(POLICIES)) -> DataFrame:
    """What each rule of each policy costs.

    (version, rule, n_failed, n_only): rows that the rule fails, and rows that would be
    kept without it. One pass counts the rows of each pattern of bits; at most 2 to the
    number of rules patterns are left to combine.
    """
    patterns = ledger.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = [
        F.struct(
            F.lit(v).alias("version"), F.lit(name).alias("rule"),
            F.lit(BIT[name]).cast("long").alias("bit"), F.lit(policy_mask(v)).cast("long").alias("mask"),
        )
        for v in versions
        for name in POLICIES[v]
    ]
    each = patterns.select("failed", "n", F.inline(F.array(*cases)))
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    return each.groupBy("version", "rule").agg(
        count(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(hit == F.col("bit")).alias("n_only"),
    )


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = rule_ledger(table(spark, sf_dir, "documents"))
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        rejected_by(BASE).alias("base_failed"),
        (~rejected_by(CURRENT)).alias("kept"),
    )


OP6_SQL = r"""
with texts as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
words as (
  select r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as w,
    generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) as i from texts),
three as (
  select r, i, w, lead(w, 1) over p as w2, lead(w, 2) over p as w3
  from words window p as (partition by r order by i)),
twice as (
  select r, i from three where w3 is not null
  qualify count(*) over (partition by r, w, w2, w3) > 1),
covered as (
  select r, count(distinct i + d) as n from twice, (values (0), (1), (2)) as v(d) group by r),
counted as (select r, count(*) as n, sum(length(w)) as chars from words group by r),
lines as (
  select r, count(*) as n, count(distinct line) as kinds
  from (select r, unnest(string_split(text, chr(10))) as line from texts)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
m as (
  select doc_id, coalesce(c.n, 0)::bigint as n_words, coalesce(c.chars, 0)::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
    coalesce(l.n - l.kinds, 0)::bigint as n_dup_lines, coalesce(v.n, 0)::bigint as n_repeat_words,
    coalesce(l.n, 0) as n_lines
  from texts left join counted c using (r) left join covered v using (r) left join lines l using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or 10 * n_symbols > n_words
    or 10 * n_dup_lines > 3 * n_lines or word_chars < 2 * n_words or word_chars > 20 * n_words) as kept
from m
"""
