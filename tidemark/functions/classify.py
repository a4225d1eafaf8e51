"""Threshold classes and enumerated domains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Classes and their strict lower bounds, best first.
SCORING_THRESHOLDS = (("star", 20), ("good", 15), ("average", 10))
RATING_THRESHOLDS = (("star", 8), ("good", 7), ("average", 6))
LOWEST_CLASS = "bad"

# Members of each enumerated type.
QUALITY_CLASSES = ("star", "good", "average", "bad")
SCORING_CLASSES = ("star", "good", "average", "bad")
PLAYER_STATES = (
    "New",
    "Retired",
    "Continued Playing",
    "Returned from Retirement",
    "Stayed Retired",
)
VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")


def threshold_class(
    score: Column,
    thresholds: Sequence[tuple[str, float]],
    otherwise: str = LOWEST_CLASS,
) -> Column:
    """First class whose bound the score exceeds; a null score is ``otherwise``."""
    name, bound = thresholds[0]
    chain = F.when(score > bound, name)
    for name, bound in thresholds[1:]:
        chain = chain.when(score > bound, name)
    return chain.otherwise(otherwise)
