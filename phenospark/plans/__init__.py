"""Plans: the contract queries (Spark + DuckDB twins) and the end-to-end
jobs that chain the operators and materialise each stage."""
