"""DataFrame operators: merges, cursors, relational forms, time series, reports and checks."""
