"""Training-data operators: licence scan, quality rules, packing, WARC
derivatives, near-duplicates, language models, mixing, token counts, ANN.

Nothing else in the library imports this subpackage.
"""
