"""The registered queries of the subpackage, each beside the SQL it must equal where SQL can say it."""

from __future__ import annotations

from rowloom.llm.queries import alignment, archives, benchmarks, chats, duplicates, encoding, linededup, models, private, quality, repeats

_MODULES = [alignment, archives, benchmarks, chats, duplicates, encoding, linededup, models, private, quality, repeats]

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
