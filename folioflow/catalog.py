"""All registered queries and their SQL."""

from __future__ import annotations

import importlib
import pkgutil

from folioflow import plans
from folioflow.registry import ORACLES, QUERIES, Query

for _module in pkgutil.iter_modules(plans.__path__):
    importlib.import_module(f"folioflow.plans.{_module.name}")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
