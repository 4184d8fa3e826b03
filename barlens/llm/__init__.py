"""Operators of a large-scale training-data pipeline.

Each module holds one operator with its own general interface; ``queries``
registers one production query per operator. Nothing outside this subpackage
imports it, except ``corpus_pipeline.py`` and the guarded import of
``__spark_entry__.py``.
"""
