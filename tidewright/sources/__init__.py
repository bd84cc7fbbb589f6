"""Reading and writing files, envelopes and message batches."""
