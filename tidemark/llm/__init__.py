"""Operators for training-data pipelines over a ``documents`` table.

Each operator lives in its own module with a general interface; ``queries``
derives the registered ``opN_<name>`` tables from them. Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it.
"""
