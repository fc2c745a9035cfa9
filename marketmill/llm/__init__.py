"""Operators for preparing training data; their registered queries are in ``queries``."""
