"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface; ``queries``
registers them over the ``documents``, ``labels``, ``benchmark`` and
``embeddings`` tables. Nothing outside this package imports it.
"""
