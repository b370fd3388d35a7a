"""Labelled-text analytics as Spark DataFrame operators."""
