"""Spark-native analytics for mass-spectrometry proteomics tables and sequences."""
