"""Curation of labelled, multi-source collections as Spark jobs."""
