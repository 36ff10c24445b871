"""DataFrame operators: latest-record dedup, merge, period joins, rolling means, checks."""
