"""Operators for training-data pipelines; their registered queries are in ``rollbook.llm.queries``."""
