"""Training-data operators: quality rules, mixing, chat formatting, de-duplication, tokenizing,
WARC archives, sharding and quality classification.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
