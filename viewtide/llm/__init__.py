"""Training-data operators: personal data, deduplication, extraction, scoring, mixing, output.

Nothing else in the library imports this subpackage; its queries are registered by ``queries``.
"""
