"""Choosing an article's body among candidate texts of its page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions.text import let
from gleaner.operators.quality import looks_like_noise


def choose_candidate(candidates: Column, preference: list[str] | None = None, max_link_ratio: float = 0.6) -> Column:
    """First selector of the preference order with usable text; null when there is none."""
    order = F.array(*[F.lit(s) for s in (preference or K.SELECTOR_PREFERENCE)])

    def usable(c: Column) -> Column:
        return (c["text_length"] > 0) & (c["link_text_ratio"] <= max_link_ratio) & ~looks_like_noise(c["text"])

    def first_of(good: Column) -> Column:
        # A later candidate under one selector replaces an earlier one.
        picks = F.transform(order, lambda s: F.try_element_at(F.filter(good, lambda c: c["selector"] == s), F.lit(-1)))
        return F.try_element_at(F.filter(picks, lambda c: c.isNotNull()), F.lit(1))

    return let(F.filter(candidates, usable), first_of)


def longest_candidate(candidates: Column, primary: str = K.SAMPLE_SELECTORS[0], order: list[str] | None = None) -> Column:
    """Longest text in selector order, the first of equals; any text under the primary selector ends the search."""
    names = order or K.SAMPLE_SELECTORS

    def placed(c: Column, i: Column) -> Column:
        rank = F.array_position(F.array(*[F.lit(n) for n in names]), c["selector"])
        return F.struct((-c["text_length"]).alias("size"), rank.alias("rank"), i.alias("at"), c.alias("c"))

    known = F.filter(candidates, lambda c: c["selector"].isin(names) & (c["text_length"] > 0))
    first_choice = F.filter(known, lambda c: c["selector"] == primary)
    pool = F.when(F.size(first_choice) > 0, first_choice).otherwise(known)
    return F.array_min(F.transform(pool, placed))["c"]
