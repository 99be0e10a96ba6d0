"""A Spark-native engine for league tables: extraction, normalisation, standings, merging, validation, publishing."""
