"""Operators for preparing training data; their queries are in ``queries``. Nothing else in the library imports this."""
