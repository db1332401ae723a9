"""Operators for preparing training text at scale.

One module per operator; ``queries`` registers them over the test tables. Nothing
outside this folder imports it.
"""
