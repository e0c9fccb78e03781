"""Operators of a training-data pipeline: classification, near-duplicates,
decontamination, extraction, tokenisation, personal data and sharding.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its general interface; ``queries`` registers the thin
``opN_<name>`` queries over the given tables.
"""
