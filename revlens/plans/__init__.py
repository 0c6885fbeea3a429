"""Composed jobs: recommendation, tuning, key n-grams, sentiment, subsets."""
