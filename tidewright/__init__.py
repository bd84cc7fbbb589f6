"""Change-data merges, cursors, shaping, clinical messages, time series and reports as Spark jobs."""
