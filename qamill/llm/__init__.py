"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface; ``queries``
registers one thin query per operator.  Nothing else in the library imports
this subpackage.
"""
