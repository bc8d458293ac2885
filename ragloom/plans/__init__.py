"""Whole-job plans: the RAG query side (M9), the ingest side (M10) and the registered
query catalogue used by the driver contract and the benchmark."""
