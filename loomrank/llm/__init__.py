"""Operators for preparing training corpora at cluster scale.

Nothing outside this folder imports it, so it can be removed as a whole.
"""
