"""Operators for preparing language-model training data, each a Spark job over
the tables it is given. Nothing else in the library imports this package."""
