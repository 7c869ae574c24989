"""Composed jobs: materialised split, evaluation, grid search, flagship."""
