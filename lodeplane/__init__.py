"""Spark-first building blocks for conformed dimensions, facts, resolved entities and training corpora."""
