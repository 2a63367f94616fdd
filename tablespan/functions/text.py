"""Text column helpers; all stay inside built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# an empty match on either side of every character that is not a letter or digit
WORD_EDGES = r"(?<=[^\p{L}\p{N}])|(?=[^\p{L}\p{N}])"


def proper_case(c: Column) -> Column:
    """Upper-case the first letter of each word, where any character that is neither letter nor
    digit ends a word (Spark's `initcap` alone only breaks at white space)."""
    return F.array_join(F.transform(F.split(F.lower(c), WORD_EDGES), F.initcap), "")


def nth_position(c: Column, mark: str, n: int) -> Column:
    """1-based position of the n-th `mark`, 0 when there are fewer."""
    found = F.length(c) - F.length(F.replace(c, F.lit(mark))) >= n * len(mark)
    return F.when(found, F.length(F.substring_index(c, mark, n)) + 1).otherwise(
        F.when(c.isNotNull(), F.lit(0)))


def last_token(c: Column, mark: str = " ") -> Column:
    """What follows the last `mark`; the whole text when there is none."""
    return F.substring_index(c, mark, -1)


def joined(*parts: Column | str) -> Column:
    """Concatenation in which a NULL part counts as an empty text."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def contains_ci(c: Column, needle: str) -> Column:
    """Case-insensitive containment; `%` and `_` in the needle are ordinary characters."""
    return F.lower(c).contains(F.lower(F.lit(needle)))


def percent_text(ratio: Column) -> Column:
    """A share as percent text with three integer digits and six decimals, e.g. `000.149100`."""
    return F.to_char((ratio * 100).cast("decimal(12,6)"), F.lit("099D999999"))
