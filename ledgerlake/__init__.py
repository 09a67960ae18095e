"""Trade-ledger lakehouse operators: plain functions from DataFrames to DataFrames."""
