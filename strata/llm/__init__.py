"""Operators of a training-data pipeline (deduplication, filtering, scoring,
tokenisation, archives, vector search).  Nothing else in the library imports
this subpackage; ``strata.llm.queries`` holds the registered queries."""
