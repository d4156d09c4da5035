"""Training-data operators: decontamination, language, duplicates, tokens, quality, secrets.

Nothing outside this subpackage imports it. ``queries`` registers one query
per operator; ``/corpus_pipeline.py`` chains five of them.
"""
