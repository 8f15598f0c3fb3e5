"""Operators for preparing training data: mixing, cleaning, near-duplicates,
toxicity, URL lists, tokenising, language, and language-model scores.

Nothing else in the library imports this subpackage.  Each operator has a module
of its own; ``queries`` registers one query per operator.
"""
