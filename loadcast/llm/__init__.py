"""Operators for preparing training text at scale: quality rules, line and
substring dedup, similarity joins, page extraction, sharding, source mixing,
language-model scoring and SentencePiece encoding.

Each module holds one operator with its general interface; ``queries`` applies
every operator to its whole table. Nothing outside this subpackage imports it.
"""
