"""Spark-native content lake: land, load, model, test and report on web content."""
