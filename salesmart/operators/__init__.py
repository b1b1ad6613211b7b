"""DataFrame operators: quality, enrichment, marts, keyed merges, stock, RFM, affinity, recommendations."""
