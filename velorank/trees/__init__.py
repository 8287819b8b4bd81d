"""Regression trees grown by distributed histograms, for many trees, configs and folds in shared passes."""
