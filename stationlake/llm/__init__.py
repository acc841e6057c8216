"""Operators for building training corpora from documents and web pages.

Nothing else in the library imports this subpackage. The operators are in one
module each; ``queries`` applies them to whole tables.
"""
