"""Column functions: change envelopes, derived measures, time, keys."""
