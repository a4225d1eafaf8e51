"""Activity of the last 32 days packed into one 32-bit word."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BITS = 32
# All 32 bits, the top seven, the top one.
WORD_MASK = 4294967295
WEEK_MASK = 4261412864
DAY_MASK = 2147483648


def datelist_word(dates: Column, as_of: Column, first: Column, last: Column, top: int) -> Column:
    """Sum of one bit per listed date: bit ``top - days before as_of``.

    ``top=32`` puts ``as_of`` itself just above the word, so that day is lost;
    ``top=31`` keeps it as the highest bit. Dates outside ``[first, last]`` or
    the word add nothing. No date spine is generated: the list is folded in place.
    """
    low, high = top - (WORD_BITS - 1), top

    def in_word(day: Column) -> Column:
        age = F.date_diff(as_of, day)
        return (day >= first) & (day <= last) & age.between(max(low, 0), high)

    def add_bit(word: Column, day: Column) -> Column:
        # The explicit cast keeps the fold's type stable under ANSI.
        shift = F.lit(top) - F.date_diff(as_of, day)
        return word + F.call_function("shiftleft", F.lit(1).cast("long"), shift)

    return F.aggregate(
        F.array_distinct(F.filter(dates, in_word)), F.lit(0).cast("long"), add_bit
    )


def low_word(value: Column) -> Column:
    """Keep the low 32 bits, as a cast to a 32-bit string does."""
    return value.bitwiseAND(F.lit(WORD_MASK))


def word_text(word: Column) -> Column:
    """The word as 32 binary digits."""
    return F.lpad(F.bin(word), WORD_BITS, "0")


def active_days(word: Column, mask: int = WORD_MASK) -> Column:
    """Number of set bits under a mask."""
    return F.bit_count(word.bitwiseAND(F.lit(mask)))
