"""Column expressions over the words of a text, for operators that stay in DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """Words of a text; none for null and white space."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def window_hashes(words_: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order."""
    hashed = F.transform(words_, lambda w: F.xxhash64(w))
    return let(
        hashed,
        lambda h: F.when(
            F.size(h) >= size,
            F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(size)))),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def repeated_words(words_: Column, size: int) -> Column:
    """Words covered by runs of ``size`` words that occur twice or more."""

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(
            placed,
            lambda s: F.array_sort(
                F.transform(
                    F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])),
                    lambda x: x["i"],
                )
            ),
        )
        gaps = let(twice, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1) - x, F.lit(size)))), F.lit(0), lambda s, x: s + x))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(gaps)

    return let(window_hashes(words_, size), covered).cast("long")
