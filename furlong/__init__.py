"""Feature, encoding and scoring operators for event-result tables, on Spark DataFrames."""
