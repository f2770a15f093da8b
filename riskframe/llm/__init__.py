"""Training-data operators: dedup, decontamination, language, quality, mixing, output.

Nothing outside this package imports it; ``queries`` holds the registered queries.
"""
