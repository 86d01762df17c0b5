"""Role-dependent masks. Masked forms are fixed values.

Which roles see what is a parameter, ``tiers``; the default knows the roles of both naming schemes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIVILEGED, ANALYST, OTHER = "privileged", "analyst", "other"

# Two naming schemes are in use for the same roles. Any role not listed gets the full mask.
ROLE_TIERS = {
    "CAPSTONE_SYSADMIN": PRIVILEGED,
    "CAPSTONE_DATA_ENGINEER": PRIVILEGED,
    "CAPSTONE_ANALYST": ANALYST,
    "ADMIN_ROLE": PRIVILEGED,
    "DATA_ENGINEER_ROLE": PRIVILEGED,
    "ANALYST_ROLE": ANALYST,
}


def tier_of(role: str, tiers: Mapping[str, str] = ROLE_TIERS) -> str:
    """Tier of a role, whatever the case of its name; a role not listed is ``OTHER``."""
    return {name.upper(): tier for name, tier in tiers.items()}.get(role.upper(), OTHER)


def _for_tier(role: str, tiers: Mapping[str, str], raw: Column, partial: Column, full: Column) -> Column:
    return {PRIVILEGED: raw, ANALYST: partial, OTHER: full}[tier_of(role, tiers)]


def _word(value: Column, index: int) -> Column:
    return F.split_part(value, F.lit(" "), F.lit(index))


def _initial(value: Column) -> Column:
    return F.left(value, F.lit(1))


def mask_email(value: Column, role: str, tiers: Mapping[str, str] = ROLE_TIERS) -> Column:
    domain = F.split_part(value, F.lit("@"), F.lit(2))
    return _for_tier(role, tiers, value, F.concat(_initial(value), F.lit("***@"), domain), F.lit("***@***.com"))


def mask_full_name(value: Column, role: str, tiers: Mapping[str, str] = ROLE_TIERS) -> Column:
    first, last = _word(value, 1), _word(value, 2)
    shortened = F.concat(first, F.lit(" "), _initial(last), F.lit("."))
    initials = F.concat(_initial(first), F.lit("."), _initial(last), F.lit("."))
    return _for_tier(role, tiers, value, shortened, initials)


def mask_income(value: Column, role: str, tiers: Mapping[str, str] = ROLE_TIERS) -> Column:
    return _for_tier(role, tiers, value, F.round(value, -4).cast("long"), F.lit(0).cast("long"))


def mask_birth_date(value: Column, role: str, tiers: Mapping[str, str] = ROLE_TIERS) -> Column:
    return _for_tier(role, tiers, value, F.trunc(value, "year"), F.lit(None).cast("date"))


def mask_phone(value: Column, role: str, tiers: Mapping[str, str] = ROLE_TIERS) -> Column:
    return _for_tier(role, tiers, value, F.concat(F.lit("***-***-"), F.right(value, F.lit(4))), F.lit("***-***-****"))
