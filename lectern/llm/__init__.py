"""Operators for preparing language-model training data; one module per operator, see ``queries`` for the entries."""
