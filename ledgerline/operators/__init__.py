"""DataFrame operators: upsert, dedupe, rollups, reconciliation, lookups, nesting."""
