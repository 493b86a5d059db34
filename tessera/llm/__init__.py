"""Training-data operators: language, quality and toxicity models, near-duplicate and
substring removal, decontamination, mixing, token counts, vector search, page text.

``tessera.llm.queries`` registers one query per operator; nothing outside this package
imports it, except the guarded import in ``__spark_entry__.py``.
"""
