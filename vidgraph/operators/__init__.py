"""DataFrame operators: ingest, catalogue, search, network aggregation, influence."""
