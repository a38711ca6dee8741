"""Named queries over the given tables."""

import importlib
import pkgutil

from microbook.queries.registry import ORACLES, QUERIES  # noqa: F401

for _module in pkgutil.iter_modules(__path__):
    if _module.name.startswith("q_"):
        importlib.import_module(f"{__name__}.{_module.name}")
