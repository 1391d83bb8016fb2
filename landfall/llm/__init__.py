"""Operators for preparing training text: filters, near duplicates, packing, sharding and files.

Each operator takes DataFrames and returns a DataFrame. ``queries`` registers one query per
operator; nothing outside this package imports it.
"""
