"""Training-data pipeline operators.

Each module holds one operator with its own general interface; the thin
``opN_*`` queries in :mod:`tessera.llm.queries` apply them to whole driver
tables.  Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
