"""Operators of a training-data pipeline: deduplication, tokenising, packing,
filtering, archives and scoring of document collections. Nothing outside this
package (and ``corpus_pipeline.py``) imports it."""
