"""Operators for preparing training text: counting, encoding, scoring, packing, deduplicating, searching.

Every operator takes a DataFrame and the names of the columns to use, selects them first (other columns,
whatever their names, never matter) and documents what it does with nulls, empty texts and repeated rows.
"""
