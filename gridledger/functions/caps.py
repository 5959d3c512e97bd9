"""Caps and predicates on priorities, tiers, years and members."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridledger.lookup import ESM_DENY


def cap_years(years: Column, limit: Column) -> Column:
    """``years`` capped by ``limit``; a negative limit is no cap."""
    return F.when(limit < 0, years).otherwise(F.least(years, limit))


def members_for_tier(sizes: Column, tiers: Column, limit: Column, tier_max: int) -> Column:
    """Ensemble size at the last tier up to ``tier_max``, capped by a non-negative ``limit``; 0 if no tier qualifies.

    ``tier_max`` of 0 or less means that tiers do not restrict, so the last tier counts.
    A repeated tier takes the size at its first place.
    """
    allowed = tiers if tier_max <= 0 else F.filter(tiers, lambda t: t <= tier_max)
    last = F.try_element_at(allowed, F.lit(-1))
    place = F.array_position(tiers, last)          # NULL when no tier qualifies
    size = F.try_element_at(sizes, F.when(place > 0, place.cast("int")))
    capped = F.when(limit < 0, size).otherwise(F.least(size, limit))
    return F.when(last.isNull(), F.lit(0)).otherwise(capped).cast("bigint")


def first_tier_passes(tiers: Column, tier_max: int | None) -> Column:
    """The first tier is within ``tier_max``; None, 0 or a negative number switches the filter off."""
    if tier_max is None or tier_max <= 0:
        return F.lit(True)
    return F.try_element_at(tiers, F.lit(1)) <= tier_max


def reset_passes(treset: Column, tier_max: int) -> Column:
    """Tier reset filter on request items: absent, or not above ``tier_max``; a negative maximum keeps everything."""
    if tier_max < 0:
        return F.lit(True)
    return treset.isNull() | (treset <= tier_max)


def preset_passes(preset: Column, pmax: int) -> Column:
    return (preset < 0) | (preset <= pmax)


def effective_priority(preset: Column, priority: Column) -> Column:
    """The preset of the item replaces the priority of the variable unless it is -1."""
    return F.when(preset != -1, preset).otherwise(priority)


def category_passes(mcfg: Column, requested: list[str], strict: bool = False) -> Column:
    """Model-category filter on text of the form ``required words | allowed words``.

    An experiment passes if each required component is available.  AOGCM brings AGCM, and AGCM brings LAND and RAD.
    ``strict`` also wants every requested category among the required and allowed ones.
    """
    available = list(requested)
    if "AOGCM" in available:
        available.append("AGCM")
    if "AGCM" in available:
        available += ["LAND", "RAD"]
    words = lambda i: F.filter(F.split(F.trim(F.get(F.split(mcfg, r"\|"), F.lit(i))), " +"), lambda w: w != "")
    required, allowed = words(0), F.coalesce(words(1), F.array().cast("array<string>"))
    lit_array = lambda xs: F.array(*[F.lit(x) for x in xs])
    ok = F.size(F.array_except(required, lit_array(available))) == 0
    if strict:
        ok = ok & (F.size(F.array_except(lit_array(requested), F.concat(required, allowed))) == 0)
    return ok


def not_esm(label: Column) -> Column:
    """The default deny list of Earth-system experiments."""
    return ~label.isin(ESM_DENY)
