"""Quality rules: a table of thresholds compiled into one projection.

A rule names a measure, what it is a share of, and the percentages it must lie between. All measures
of a text are worked out by built-in functions in one projection over the table, without a shuffle.
Windows of words are recognised by 64-bit hashes within their own text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it with as on was by are this be not or from at an "
    "der die das und zu den mit von ist des sich nicht auf im dem ein eine "
    "de la le et les en un une du que qui est pour dans par sur au "
    "el los las y del se una por con no su para es"
).split()


@dataclass(frozen=True)
class Rule:
    """`least` <= 100 * measure / base <= `most`, either end left open by None, for texts whose base
    is at least `from_base`; the share says little below that."""

    measure: str
    base: str
    least: int | None = None
    most: int | None = None
    from_base: int = 1


#: The threshold table. Lengths are characters per word times 100.
RULES = (
    Rule("word_chars", "n_words", least=150, most=2500),
    Rule("n_symbols", "n_words", most=30),
    Rule("n_stop_words", "n_words", least=2, from_base=50),
    Rule("n_dup_lines", "n_lines", most=50, from_base=4),
)


def _let(value: Column, body) -> Column:
    """`body` of a value that is worked out once, also where a lambda inside reads it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(text: Column) -> Column:
    trimmed = F.regexp_replace(text, f"^{SPACE}+|{SPACE}+\\z", "")
    none = F.array().cast("array<string>")
    return F.when(F.length(trimmed) == 0, none).otherwise(F.split(trimmed, SPACE + "+", -1))


def _repeated_words(words: Column) -> Column:
    """How many words lie in windows that occur twice or more."""
    n = F.size(words) - (WINDOW - 1)
    hashes = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )

    def covered(places: Column) -> Column:
        gaps = F.transform(
            places,
            lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def count(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            def like(x: Column, k: Column) -> Column:
                other = (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
                return F.when(F.coalesce(other, F.lit(False)), x["i"])

            return F.sort_array(F.array_compact(F.transform(s, like)))

        some = _let(ordered, lambda s: _let(twice(s), covered))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(some)

    return F.when(n <= 1, F.lit(0)).otherwise(_let(hashes, count)).cast("long")


def _line_counts(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(NOT_SPACE))
    return _let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )


def measures(text: Column) -> dict[str, Column]:
    """Every measure of a text by its name; a null text is an empty one."""
    text = F.coalesce(text, F.lit(""))
    of_words = _let(
        _words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        ),
    )
    chars = F.length(F.regexp_replace(text, SPACE + "+", "")).cast("long")
    symbols = (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")
    return {"__words": of_words, "__lines": _line_counts(text), "word_chars": chars, "n_symbols": symbols}


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one condition, in whole numbers."""
    passed = F.lit(True)
    for rule in rules:
        share, base = 100 * F.col(rule.measure), F.col(rule.base)
        few = base < rule.from_base
        if rule.least is not None:
            passed &= few | (share >= rule.least * base)
        if rule.most is not None:
            passed &= few | (share <= rule.most * base)
    return passed


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: `doc_id`, the measures, `base_failed` and `kept`.

    `base_failed`: fewer than ten words, or more than a fifth of the words in repeated windows.
    `kept`: not base_failed, and every rule of the table holds. A null or empty text has all
    measures 0 and fails. Other columns of `docs` are ignored.
    """
    measured = docs.select("doc_id", "text").withColumns(measures(F.col("text")))
    flat = measured.select(
        "doc_id", "__words.n_words", "word_chars", "n_symbols", "__lines.n_dup_lines",
        "__words.n_repeat_words", "__words.n_stop_words", "__lines.n_lines",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return flat.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules))


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same rows as SQL over `documents`, for whole texts."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    checks = []
    for rule in rules:
        few, share = f"{rule.base} < {rule.from_base}", f"100 * {rule.measure}"
        if rule.least is not None:
            checks.append(f"({few} or {share} >= {rule.least} * {rule.base})")
        if rule.most is not None:
            checks.append(f"({few} or {share} <= {rule.most} * {rule.base})")
    failed = f"(n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words)"
    return f"""
    with texts as (select doc_id, coalesce(text, '') as text from documents),
    split_up as (
        select doc_id, text,
               list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda x: x <> '') as words,
               list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{NOT_SPACE}')) as lines
        from texts),
    windows as (
        select doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') as gram
        from (select doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) as i from split_up)),
    twice as (
        select doc_id, i from (
            select doc_id, i, count(*) over (partition by doc_id, gram) as n from windows) where n > 1),
    covered as (
        select doc_id, sum(least({WINDOW}, coalesce(following - i, {WINDOW}))) as n
        from (select doc_id, i, lead(i) over (partition by doc_id order by i) as following from twice)
        group by doc_id),
    measured as (
        select s.doc_id, cast(len(words) as bigint) as n_words,
               cast(length(regexp_replace(text, '{SPACE}+', '', 'g')) as bigint) as word_chars,
               cast(length(text) - length(translate(text, '{SYMBOLS}', '')) as bigint) as n_symbols,
               cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
               cast(coalesce(c.n, 0) as bigint) as n_repeat_words,
               cast(len(list_filter(words, lambda x: lower(x) in ({stop}))) as bigint) as n_stop_words,
               cast(len(lines) as bigint) as n_lines
        from split_up s left join covered c using (doc_id))
    select *, {failed} as base_failed, not {failed} and {" and ".join(checks)} as kept from measured
    """
