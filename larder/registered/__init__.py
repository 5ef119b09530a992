"""The registered queries: plans and operators bound to the test tables, with their SQL twins."""

from __future__ import annotations

from larder.registered.binding import Query


def queries() -> dict[str, Query]:
    from larder.registered.business import business
    from larder.registered.derived import derived
    from larder.registered.profiles import profiles
    from larder.registered.quality import quality

    return {**business(), **quality(), **derived(), **profiles()}


def oracle_sql() -> dict[str, str]:
    from larder.oracle.business import business
    from larder.oracle.derived import derived
    from larder.oracle.profiles import profiles
    from larder.oracle.quality import quality

    return {**business(), **quality(), **derived(), **profiles()}
