"""Data-pipeline operators on Spark DataFrames: typed intake, rules and quarantine,
latest-state and type-2 history tables, as-of joins, a star schema and a quality gate."""
