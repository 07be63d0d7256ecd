"""Operators for preparing training text: filters, deduplication, decontamination and tokens.

Nothing else in the package imports this folder. Each module holds one operator with its
general interface; ``catalog`` holds the named queries and the SQL that checks them.
"""
