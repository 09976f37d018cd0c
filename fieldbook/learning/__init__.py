"""Spark ML workflows: features, candidate searches under a temporal split, clusters."""
