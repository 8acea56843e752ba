"""DataFrame -> DataFrame operators: enrichment, quality, SCD, gold, audit, drift, lineage."""
