"""Message stores, resource logs, bundle logs and dead letters."""
