"""Named queries over the driver's tables, each with a SQL twin where SQL can say the same."""

from __future__ import annotations

import importlib
import pkgutil

from gleaner.catalog import base


def load() -> tuple[dict[str, base.Query], dict[str, str]]:
    """Import every query module and return ``(queries, oracles)``."""
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{module}")
    return dict(base.QUERIES), dict(base.ORACLES)
