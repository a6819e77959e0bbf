"""Operators for preparing language-model training data on Spark.

Nothing else in the package imports this subpackage.  ``queries`` registers
one production query per operator.
"""
