"""Queries that exercise finlake on the shared tables, each with its SQL twin."""

from workloads import landing, loading, refined, storage, trusted

REGISTRY = {
    **landing.QUERIES,
    **trusted.QUERIES,
    **loading.QUERIES,
    **refined.QUERIES,
    **storage.QUERIES,
}
