"""All core queries and their SQL."""

from kuatia.plans import events, relational, scalars, publication, flows, curation, outlets  # noqa: F401  (they register their queries, in this order)
from kuatia.plans.registry import QUERIES as _REGISTERED
from kuatia.plans.registry import SQL as _SQL

QUERIES = {"p3_found": publication.p3_found, **_REGISTERED}
SQL = dict(_SQL)
