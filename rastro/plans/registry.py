"""All queries of the library outside the ``llm`` subpackage."""

from __future__ import annotations

from rastro.plans import analytics, files, problems, quality, relational, scalars

MODULES = (problems, scalars, relational, analytics, quality, files)


def queries() -> dict:
    return {name: f for module in MODULES for name, f in module.queries().items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.oracles().items()}
