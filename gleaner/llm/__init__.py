"""Operators for preparing language-model training data.

Nothing else in ``gleaner`` imports this package; the queries are in ``queries.py`` and the
staged pipeline is ``corpus_pipeline.py`` at the top of the repository.
"""
