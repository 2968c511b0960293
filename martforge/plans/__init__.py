"""Plans: staging, dimensions, fact, checks, reconciliation, marts, publish."""
