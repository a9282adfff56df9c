"""Rule bitmask ledger: every quality rule is evaluated once, policies are applied later.

``measure`` computes the measurements of a text with built-in functions only; ``ledger`` turns
them into one bit per failed rule. A policy is a version and the rules it enforces: applying
it, or asking what dropping one of its rules would change, needs the bits alone. Ablations
first count documents by bit pattern, at most ``2 ** len(RULES)`` rows whatever the corpus.

A word is a run of ``[^\\x20\\x09-\\x0D]``. Null and empty texts have no words, so measurements
are 0 and they fail ``few_words``. Rules on shares of words or letters never fail without any.
Every input row gives a row, copies too. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words", "n_marks")

#: Rules in the order of their bits, as SQL conditions of failure on integer measurements.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "n_lines > 0 AND 100 * n_dup_lines > 30 * n_lines",
    "short_words": "n_words > 0 AND word_chars < 2 * n_words",
    "long_words": "n_words > 0 AND word_chars > 15 * n_words",
    "upper_case": "2 * n_upper_words > n_words",
    "marks": "4 * n_marks > n_words",
}
BASE = ("few_words", "repeated_words")

#: Policy versions: each lists the rules it enforces.
POLICIES = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "symbols", "upper_case"),
    3: tuple(RULES),
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def removed(text: Column, characters: str) -> Column:
    """The text without these ASCII characters; ``replace`` passes over bytes, not characters."""
    return reduce(lambda kept, character: F.replace(kept, F.lit(character)), characters, text)


def lines_of(text: Column) -> Column:
    """``\\n``-split lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def covered(starts: Column, k: int) -> Column:
    """Number of positions under windows of ``k`` positions with these sorted starts."""
    nothing = F.struct(F.lit(0).alias("n"), F.lit(-k).alias("last"))
    return F.aggregate(
        starts,
        nothing,
        lambda seen, at: F.struct((seen["n"] + F.least(F.lit(k), at - seen["last"])).alias("n"), at.alias("last")),
        lambda seen: seen["n"],
    )


def window_codes(words: Column) -> Column:
    """64-bit hashes of all windows of five words, from hashes of two and of four."""
    both = lambda row, other: F.zip_with(row, other, lambda a, b: F.xxhash64(a, b))
    after = lambda row, n: F.slice(row, n + 1, F.greatest(F.size(row) - n, F.lit(0)))
    whole = lambda each: let(both(each, after(each, 1)), lambda two: both(both(two, after(two, 2)), after(each, 4)))
    codes = let(F.transform(words, lambda word: F.xxhash64(word)), whole)
    return F.slice(codes, F.lit(1), F.size(words) - 4)


def repeat_words(words: Column) -> Column:
    """Words inside windows of five words that occur at least twice in the text.

    Windows are compared by 64-bit hash. Only texts where some hash recurs sort their windows.
    """

    def repeated(codes: Column) -> Column:
        pairs = F.transform(codes, lambda code, at: F.struct(code.alias("code"), at.alias("at")))

        def starts(row: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(row, i)["code"] == F.get(row, j)["code"], F.lit(False))
            twice = F.filter(row, lambda _, i: same(i, i + 1) | same(i, i - 1))
            return F.sort_array(F.transform(twice, lambda pair: pair["at"]))

        counted = covered(let(F.sort_array(pairs), starts), 5)
        return F.when(F.size(F.array_distinct(codes)) == F.size(codes), F.lit(0)).otherwise(counted)

    return let(words, lambda w: F.when(F.size(w) <= 5, F.lit(0)).otherwise(let(window_codes(w), repeated)))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of each text, each of them a long."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id"), text.alias("text"))
    # A generator keeps the optimizer from copying the split into each use of it.
    split = rows.select("doc_id", "text", F.explode(F.array(F.struct(words_of(F.col("text")).alias("words"), lines_of(F.col("text")).alias("lines")))).alias("s"))
    size = lambda kept: F.length("text") - F.length(removed(F.col("text"), kept))
    values = {
        "n_words": F.size("s.words"),
        "word_chars": F.length(removed(F.col("text"), SPACES)),
        "n_symbols": size(SYMBOLS),
        "n_dup_lines": F.size("s.lines") - F.size(F.array_distinct("s.lines")),
        "n_repeat_words": repeat_words(F.col("s.words")),
        "n_lines": F.size("s.lines"),
        "n_upper_words": F.size(F.filter("s.words", lambda word: (word == F.upper(word)) & (word != F.lower(word)))),
        "n_marks": size("!?"),
    }
    return split.select("doc_id", *[values[name].cast("long").alias(name) for name in MEASURES])


def mask(rules: Sequence[str]) -> int:
    order = list(RULES)
    return sum(1 << order.index(rule) for rule in rules)


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``fail_bits``: bit i is set where the i-th rule of RULES fails."""
    bits = " | ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))
    return measure(docs).withColumn("fail_bits", F.expr(f"CAST({bits} AS BIGINT)"))


def passes(policy: Sequence[str]) -> Column:
    return F.col("fail_bits").bitwiseAND(mask(policy)) == 0


def apply_policy(entries: DataFrame, version: int, policies: Mapping[int, Sequence[str]] = POLICIES) -> DataFrame:
    """Ledger with ``base_failed`` and ``kept``, the verdict of one policy version."""
    return entries.select("*", (~passes(BASE)).alias("base_failed"), (passes(BASE) & passes(policies[version])).alias("kept"))


def ablations(entries: DataFrame, policies: Mapping[int, Sequence[str]] = POLICIES) -> DataFrame:
    """Per policy and enforced rule: documents that fail it, that fail it alone, and how many
    the policy would keep without it; ``common_bits`` are rules all the rejected ones fail.

    (version, rule, docs, kept, failing, only, kept_without, common_bits); ``common_bits`` is
    null where no document fails the rule. An empty ledger gives no row.
    """
    patterns = entries.groupBy("fail_bits").agg(F.count("*").alias("n"))
    named = [(v, rule, mask(rules), mask([rule])) for v, rules in policies.items() for rule in rules]
    asked = F.inline(F.array(*[F.struct(F.lit(v).alias("version"), F.lit(r).alias("rule"), F.lit(p).cast("long").alias("policy"), F.lit(b).cast("long").alias("bit")) for v, r, p, b in named]))
    hits = F.col("fail_bits").bitwiseAND(F.col("policy"))
    total = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0)).cast("long")
    fails = F.col("fail_bits").bitwiseAND(F.col("bit")) != 0
    return patterns.select("*", asked).groupBy("version", "rule").agg(
        F.sum("n").cast("long").alias("docs"),
        total(hits == 0).alias("kept"),
        total(fails).alias("failing"),
        total(hits == F.col("bit")).alias("only"),
        total((hits == 0) | (hits == F.col("bit"))).alias("kept_without"),
        F.bit_and(F.when(fails, F.col("fail_bits"))).alias("common_bits"),
    )
