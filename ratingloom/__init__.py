"""Recommendation analytics over rating tables, written as Spark DataFrame plans.

Every recommender takes long-format ``(user_id, item_id, rating, …)`` tables and
returns ``(user_id, item_id, score, rank)`` for all users in one plan.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
