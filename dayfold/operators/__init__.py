"""DataFrame operators: SCD2 merge, temporal joins, sequence windows, rules, watermarks."""
