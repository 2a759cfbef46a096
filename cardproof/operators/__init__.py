"""DataFrame operators: dedup, merge, summaries, Merkle roots, audit, anomaly."""
