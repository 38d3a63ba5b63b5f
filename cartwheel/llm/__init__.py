"""Operators of a training-data pipeline: tokens, dedup, language, mixing,
nearest neighbours and archive fixity. Nothing outside this subpackage
imports it."""
