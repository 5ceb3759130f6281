"""Distributed operators: split, counting, Naive Bayes, logistic regression,
evaluation and ranking."""
