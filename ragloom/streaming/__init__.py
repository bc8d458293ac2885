"""Incremental jobs: newly arrived files into the chunk table (S7) and a stream of
questions answered against the chunk table (S8)."""
