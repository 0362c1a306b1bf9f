"""Operators of a training-data pipeline: tokens, search, archives, filters, duplicates, mixing.

One module per operator; ``queries`` registers one query for each of them and
``entry_points`` hands them to the driver's entry module.
"""
