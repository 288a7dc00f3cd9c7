"""Table builders, the pipeline, and the contract queries on the driver tables."""
