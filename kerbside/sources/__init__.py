"""Readers, the incremental fact table, sinks, and the mapping of the test tables."""
