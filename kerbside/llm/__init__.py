"""Operators for preparing training corpora, each a Spark job over whole tables.

Nothing outside this package imports it, apart from the guarded registration in
``__spark_entry__.py`` and ``corpus_pipeline.py`` at the top of the repository.
"""
