"""Training-data operators: URL rules, near-duplicates, language, search, packing and the like.

Nothing else in the library imports this subpackage.  Each module is one operator with its own
general interface; ``queries.py`` holds the registered queries over the given tables and
``oracle.py`` the SQL forms that exist.
"""
