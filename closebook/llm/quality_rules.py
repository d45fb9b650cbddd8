"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document.  The ledger stores the measurements and one bit
for each rule that fails.  A policy is a versioned set of rules; applying it, and asking how many
documents each of its rules removes alone, are bitwise operations on the ledger, which
leave the texts alone.

Only built-in functions are used.  All measurements belong to one document and stay within its
row: repeated word windows are found by sorting the hashes of the document's own windows.

Edge cases: a null or empty text has no words and fails the rule for few words; repeated rows are
judged one by one; an empty table gives an empty ledger; columns besides id and text are not read,
and the ledger's columns keep their meaning when the input has columns of the same names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.storage import stored

#: rules, as conditions on the measurements that are true for a failing document; bit k is rule k
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "word_length": "10 * word_chars < 15 * n_words or word_chars > 20 * n_words",
    "exclamations": "100 * n_exclamations > 30 * n_words",
    "few_letters": "100 * n_letters < 50 * word_chars",
}

#: versions of the policy: the rules that remove a document
POLICIES: dict[str, tuple[str, ...]] = {
    "1": ("few_words", "repeated_windows"),
    "2": tuple(RULES),
}
CURRENT = "2"


def mask(rules) -> int:
    """The bits of some rules."""
    return sum(1 << k for k, name in enumerate(RULES) if name in rules)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the measurements and `failed`, a bit for each failing rule."""
    text = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("t"))
    split = text.select(
        "doc_id", "t",
        F.expr(r"filter(split(t, '[\\x20\\x09-\\x0D]+'), x -> x <> '')").alias("w"),
        F.expr(r"filter(split(t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')").alias("lines"),
    )
    # hashes of the windows of three words, in order; a text of fewer words has none
    hashed = split.withColumn("h", F.expr("""
        if(size(w) < 3, cast(array() as array<bigint>),
           transform(sequence(0, size(w) - 3),
                     i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))))"""))
    # starts of windows found more than once: neighbours of equal hash after sorting
    repeated = hashed.withColumn("at", F.expr("""
        if(size(array_distinct(h)) = size(h), cast(array() as array<int>),
           array_sort(flatten(transform(
             array(sort_array(transform(h, (x, i) -> named_struct('x', x, 'i', i)))),
             s -> transform(
               filter(s, (e, k) -> coalesce(get(s, k - 1).x = e.x, false)
                                   or coalesce(get(s, k + 1).x = e.x, false)),
               e -> e.i)))))"""))
    # words covered by these windows: each window adds what the one before it left free
    measured = repeated.select(
        "doc_id",
        F.expr("cast(size(w) as bigint)").alias("n_words"),
        F.expr(r"cast(length(translate(t, ' \t\n\u000b\u000c\r', '')) as bigint)")
        .alias("word_chars"),
        F.expr("cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint)")
        .alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)")
        .alias("n_dup_lines"),
        F.expr("""aggregate(at, named_struct('n', 0L, 'last', -3),
            (a, i) -> named_struct('n', a.n + least(3, i - a.last), 'last', i),
            a -> a.n)""").alias("n_repeat_words"),
        F.expr("cast(size(lines) as bigint)").alias("n_lines"),
        F.expr("cast(length(t) - length(translate(t, '!', '')) as bigint)")
        .alias("n_exclamations"),
        F.expr(r"cast(length(regexp_replace(t, '\\P{L}+', '')) as bigint)").alias("n_letters"),
    )
    bits = " | ".join(f"if({rule}, {1 << k}L, 0L)" for k, rule in enumerate(RULES.values()))
    return measured.withColumn("failed", F.expr(bits))


def kept(policy: str = CURRENT):
    """Whether a row of the ledger passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(rows: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """`policy`, `rule`, `failing`, `kept`, `kept_without`: what each rule of a policy does.

    `kept_without` counts the documents that the policy would keep without the rule.  The ledger
    is counted by bit pattern once, at most 2 to the number of rules; the rest is arithmetic.
    """
    patterns = rows.groupBy("failed").agg(F.count("*").alias("n"))
    cases = F.array(*[
        F.struct(F.lit(version).alias("policy"), F.lit(name).alias("rule"),
                 F.lit(mask(rules)).cast("bigint").alias("all"),
                 F.lit(mask([name])).cast("bigint").alias("own"))
        for version, rules in policies.items() for name in rules
    ])
    return patterns.select("failed", "n", F.explode(cases).alias("c")).select(
        "failed", "n", "c.*"
    ).groupBy("policy", "rule").agg(
        F.expr("sum(if(failed & own <> 0, n, 0))").alias("failing"),
        F.expr("sum(if(failed & all = 0, n, 0))").alias("kept"),
        F.expr("sum(if(failed & (all & ~own) = 0, n, 0))").alias("kept_without"),
    )


def rule_ablations(spark, sf_dir: str) -> DataFrame:
    """`ablations` of every policy version, from the stored ledger of the whole table.

    The texts are measured once; the stored bits answer every policy.
    """
    rows = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return ablations(stored(rows, "ledger"))


def op7(spark, sf_dir: str) -> DataFrame:
    rows = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.col("failed").bitwiseAND(F.lit(mask(POLICIES["1"]))) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), kept().alias("kept"), "failed",
    )
