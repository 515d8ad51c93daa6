"""Training-data operators: dedup, decontamination, extraction, scoring, packing.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries only when it is present.
"""
