"""Exact similarity predicates as expressions.

The text ratio is the normalised indel similarity 2*LCS/(len a + len b). Thresholds are given as
the percentage of characters that may differ and compared in integers, so that no result hangs on
floating point.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: Column, b: Column) -> Column:
    """Longest common subsequence by folding the dynamic-programming rows over the letters of a."""
    start = F.array_repeat(F.lit(0), F.length(b) + 1)
    columns = F.sequence(F.lit(1), F.length(b))

    def next_row(row: Column, letter: Column) -> Column:
        def next_cell(done: Column, j: Column) -> Column:
            cell = F.when(
                F.substring(b, j, F.lit(1)) == letter, F.get(row, j - 1) + 1
            ).otherwise(F.greatest(F.get(row, j), F.element_at(done, -1)))
            return F.concat(done, F.array(cell))

        return F.aggregate(columns, F.array(F.lit(0)), next_cell)

    letters = F.transform(
        F.sequence(F.lit(1), F.length(a)), lambda i: F.substring(a, i, F.lit(1))
    )
    table = F.aggregate(letters, start, next_row)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(
        F.element_at(table, -1)
    )


def lcs_length_batched(a: Column, b: Column) -> Column:
    """`lcs_length` for many pairs: an Arrow-batched function that keeps a table row in the bits of
    one integer (Hyyrö 2004), about a hundred times faster than the folded expression."""

    def lengths(left: pd.Series, right: pd.Series) -> pd.Series:
        def common(x: str | None, y: str | None) -> int | None:
            if not isinstance(x, str) or not isinstance(y, str):
                return 0 if x == "" or y == "" else None
            places: dict[str, int] = {}
            for i, letter in enumerate(y):
                places[letter] = places.get(letter, 0) | (1 << i)
            ones = (1 << len(y)) - 1
            row = ones
            for letter in x:
                hit = row & places.get(letter, 0)
                row = ((row + hit) | (row - hit)) & ones
            return len(y) - row.bit_count()

        return pd.Series([common(x, y) for x, y in zip(left, right, strict=True)], dtype="Int32")

    return F.pandas_udf(lengths, "int")(a, b)


def indel_distance(a: Column, b: Column) -> Column:
    return F.length(a) + F.length(b) - 2 * lcs_length(a, b)


def ratio(a: Column, b: Column) -> Column:
    """0..1; two empty texts are equal, a missing text resembles nothing."""
    total = F.length(a) + F.length(b)
    score = F.when(total == 0, F.lit(1.0)).otherwise(2 * lcs_length_batched(a, b) / total)
    return F.coalesce(score, F.lit(0.0))


def indel_budget(a: Column, b: Column, slack_percent: int) -> Column:
    """Largest indel distance at which ratio(a, b) > 1 - slack_percent/100."""
    return F.floor(((F.length(a) + F.length(b)) * slack_percent - 1) / 100).cast("int")


def letter_bits(text: Column) -> Column:
    """64 bits, one for every (letter, how many-eth of its kind), shared by hashing.

    Inserting or deleting one letter changes at most one bit, so the number of differing bits of
    two texts never exceeds their indel distance.
    """

    def add(bits: Column, i: Column) -> Column:
        head = F.substring(text, F.lit(1), i)
        letter = F.substring(text, i, F.lit(1))
        nth = F.length(head) - F.length(F.replace(head, letter, F.lit("")))
        place = F.pmod(F.xxhash64(letter, nth), F.lit(64)).cast("int")
        return bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))

    places = F.filter(F.sequence(F.lit(0), F.length(text)), lambda i: i > 0)
    return F.aggregate(places, F.lit(0).cast("long"), add)


def may_be_above(
    a: Column, b: Column, bits_a: Column, bits_b: Column, slack_percent: int
) -> Column:
    """Cheap necessary conditions of `ratio_above`, in generated code: letter bits first, then the
    edit distance, which is never larger than the indel distance and stops at the budget."""
    limit = indel_budget(a, b, slack_percent)
    within = F.call_function("levenshtein", a, b, limit) >= 0
    return (a == b) | ((F.bit_count(bits_a.bitwiseXOR(bits_b)) <= limit) & within)


def ratio_above(a: Column, b: Column, slack_percent: int) -> Column:
    """ratio(a, b) > 1 - slack_percent/100, exactly.

    Edit distance brackets indel distance: lev <= indel <= 2*lev. It decides most pairs; only those
    in between pay for the LCS.
    """
    budget = (F.length(a) + F.length(b)) * slack_percent  # similar iff 100 * indel < budget
    lev = F.levenshtein(a, b)
    return F.coalesce(
        F.when(a == b, F.lit(True))
        .when(100 * lev >= budget, F.lit(False))
        .when(200 * lev < budget, F.lit(True))
        .otherwise(100 * indel_distance(a, b) < budget),
        F.lit(False),
    )


def tokens_match(a: Column, b: Column, max_distance: int = 1) -> Column:
    return F.levenshtein(a, b, max_distance) >= 0


def cosine(a: Column, b: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two arrays; 0 when both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)
