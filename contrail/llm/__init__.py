"""Training-data operators: near, exact, line and substring dedup, language-model
scoring, packing, PII, license scans, decontamination and language ID.

Nothing else in the library imports this package; it may be deleted whole.
"""
