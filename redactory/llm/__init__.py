"""Operators that prepare training data for language models, with their registered queries."""
