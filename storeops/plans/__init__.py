"""Named queries over the mart; importing the package fills the catalogue."""

import importlib
import pkgutil

from storeops.plans.registry import CATALOGUE, Query, query

for _module in sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name.startswith("run_")):
    importlib.import_module(f"{__name__}.{_module}")

__all__ = ["CATALOGUE", "Query", "query"]
