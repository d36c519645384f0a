"""Operators of a training-data pipeline over document, conversation and benchmark tables.

Nothing else in the library imports this subpackage. Every module holds one
operator; ``queries`` registers one thin query per operator.
"""
