"""Layer operators: staging/quarantine, marts, quality checks, ingest,
dead-letter sink and snapshots."""
