"""oreline: raw events to clean tables, resolved customers, marts and graph answers on Spark."""
