"""Operators for preparing language-model training data.

Nothing outside this folder imports it; its queries are registered only when it is there.
"""
