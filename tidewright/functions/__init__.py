"""Column functions and jobs that conform raw values to types."""
