"""Operators for preparing training data: near copies, packing, language models, search, privacy.

Every module holds one operator with a general interface; ``queries`` applies each to its whole
table.  Nothing outside this package imports it.
"""
