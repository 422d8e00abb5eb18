"""Operators for preparing language-model training data.

Each module holds one operator with a general interface; ``queries`` holds the
thin registered queries and ``oracle`` their SQL. Nothing outside this
subpackage imports it.
"""
