"""Classifiers, ensembles and model selection on (key, features, label) tables."""
