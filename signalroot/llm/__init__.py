"""Operators for preparing training text at scale.

Nothing outside this folder imports it; `queries` registers one query per
operator and `corpus_pipeline.py` at the repository top chains five of them.
"""
