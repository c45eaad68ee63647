"""The bank configuration: fixtures derived from the test tables, contract queries, the daily run."""
