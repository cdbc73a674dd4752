"""Query plans: the analytics library and the batch pipeline."""
