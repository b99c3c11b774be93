"""Operations on training text: each operator is one module; ``queries`` registers them.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
