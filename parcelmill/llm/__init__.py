"""Operators for preparing training text. Nothing outside this folder and
``corpus_pipeline.py`` imports it."""
