"""Framewright: Spark-native keyframe selection, coverage and corpus operators."""
