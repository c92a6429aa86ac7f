"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; it may be removed as a whole.
"""
