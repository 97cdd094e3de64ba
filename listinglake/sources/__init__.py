"""Landing tables, lookups, sinks, and one normaliser module per source."""
