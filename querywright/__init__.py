"""Spark jobs for question answering over tables: golden queries, profiling,
cleaning, curation, evaluation, retrieval and prompt building."""
