import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from ratingloom.sources.session import local_session

    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def random_ratings(spark):
    """40 users, 25 items, one user with all items and one item with all users."""
    import numpy as np

    rng = np.random.default_rng(5)
    rows = {}
    for user in range(1, 41):
        for item in range(1, 26):
            if user == 7 or item == 3 or rng.random() < 0.3:
                if not (user == 7 and item > 20):
                    rows[user, item] = float(rng.integers(1, 11)) / 2
    data = [(u, i, r, 1000 + n, n) for n, ((u, i), r) in enumerate(rows.items())]
    frame = spark.createDataFrame(data, "user_id bigint, item_id bigint, rating double, ts bigint, event_id bigint")
    return frame.persist(), rows
