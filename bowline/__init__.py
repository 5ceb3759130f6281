"""bowline: bag-of-words text classification as Spark DataFrame plans.

Documents become a sparse long term table; per-class statistics, multinomial
Naive Bayes, multinomial logistic regression by full-batch gradient descent,
evaluation and ranking are all expressed as DataFrame joins, aggregations and
column expressions so that Catalyst plans them and the work scales with the
cluster.
"""

from bowline.session import get_session, checkpoint_dir, broadcast_limit_bytes

__all__ = ["get_session", "checkpoint_dir", "broadcast_limit_bytes"]
