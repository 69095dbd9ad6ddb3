"""DataFrame-to-DataFrame operators: features, similarity, recommenders."""
