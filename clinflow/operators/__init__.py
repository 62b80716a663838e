"""DataFrame operators: outcomes, lookups, mapping, store scans, resources, segments, metrics."""
