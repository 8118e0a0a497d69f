"""Spot fraudulent card transactions with Spark: prepare, train, track and score."""
