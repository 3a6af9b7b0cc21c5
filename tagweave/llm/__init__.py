"""Training-data operators: thirteen corpus operators and the helpers they share.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
