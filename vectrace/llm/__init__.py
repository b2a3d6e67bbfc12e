"""Training-data operators: ten stand-alone components and the corpus pipeline built from them.

Nothing outside this package imports it.  ``catalog`` holds the registered queries and their SQL.
"""
