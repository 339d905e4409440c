"""Operators for preparing training text: search, rules, scans, classifiers, deduplication, packing and sharding.

Each module holds one operator with its own interface; :mod:`beaconry.llm.queries` registers them over the test tables.
"""
