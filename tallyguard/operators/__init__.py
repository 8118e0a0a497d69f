"""Preparation, features, training, evaluation, tracking and scoring."""
