"""Estimators, fold assignment, grid / nested cross-validation, train and evaluate."""
