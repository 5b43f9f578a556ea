"""Training-data operators (subpackage ``llm``).

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports
it; ``__spark_entry__.py`` adds its queries when it can be imported.
"""
