"""The queries the driver runs: every operator over the given tables, with expected SQL."""
