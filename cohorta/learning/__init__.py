"""Preprocessing, classifiers, calibration and search on Spark ML."""
