"""From configuration to DataFrames: settings, checkpoints, ingestion plans."""
