"""Relational, statistical, sampling, ranking, feature and model operators."""
