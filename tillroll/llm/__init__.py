"""Training-data operators: each module holds one operator and its helpers.

Nothing outside this package, ``corpus_pipeline.py`` and ``tests/llm`` imports
it; ``queries.py`` registers the operators' queries.
"""
