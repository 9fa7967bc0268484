"""Operators for preparing training text: scrubbing, scoring, deduplication, extraction, packing.

Nothing outside this folder imports it. Each module holds one operator as a
``DataFrame -> DataFrame`` function; ``queries`` registers them on the test tables.
"""
