"""Operators that prepare text corpora for language-model training.

Nothing else in the library imports this subpackage. Each operator lives in a module of its
own; ``queries`` holds the thin registered queries.
"""
