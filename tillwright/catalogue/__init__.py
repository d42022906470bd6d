"""All registered queries."""

from __future__ import annotations

from tillwright.catalogue import (  # noqa: F401
    changes,
    cleaning,
    dataquality,
    jobs,
    joins,
    reports,
    storage,
)
from tillwright.catalogue.base import CHECKS, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def checks() -> dict[str, str]:
    return dict(CHECKS)
