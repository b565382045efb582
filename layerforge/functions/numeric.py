"""Safe numeric parsing, nullification and the Bayesian rating score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a plain decimal with an optional minus. `1e5`, `+3` and `.5` are not plain decimals.
PLAIN_DECIMAL_PATTERN = r"^\s*-?\d+(\.\d+)?\s*$"

# Fixed value: votes the global mean counts for in the Bayesian score.
PRIOR_VOTES = 20

# The closed range of a rating.
RATE_LOW, RATE_HIGH = 0, 5


def plain_double(c: Column) -> Column:
    """Text to double, NULL for anything that is not a plain decimal.

    The pattern decides what is accepted; `try_cast` only keeps an ANSI session
    from failing on a value that the pattern lets through and the cast does not.
    """
    return F.when(c.rlike(PLAIN_DECIMAL_PATTERN), c.try_cast("double"))


def null_if(c: Column, bad: Column) -> Column:
    """NULL where `bad` is true; an undecided (NULL) predicate keeps the value."""
    return F.when(bad, F.lit(None)).otherwise(c)


def cents(c: Column) -> Column:
    return F.round(c.cast("double"), 2)


def bayes_score(
    rate: Column, votes: Column, global_mean: Column, prior_votes: int = PRIOR_VOTES
) -> Column:
    """Mean of the rate and the global mean, weighted by votes and prior votes."""
    prior = F.lit(prior_votes)
    return (prior * global_mean + rate * votes) / (prior + votes)
