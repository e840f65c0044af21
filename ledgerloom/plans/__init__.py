"""Whole jobs (rebuild, recover) and the registered queries."""
