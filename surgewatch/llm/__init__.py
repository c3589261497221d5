"""Training-data operators: dedup, decontamination, tokens, packing, language, HTML, quality.

Nothing else in the library imports this subpackage.
"""
