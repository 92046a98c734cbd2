"""Operators for large training-data pipelines.

One module per operator; ``queries`` registers them. Nothing outside this
package (and ``corpus_pipeline.py``) imports it.
"""
