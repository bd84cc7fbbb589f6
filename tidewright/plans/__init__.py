"""Jobs that shape raw records into typed tables."""
