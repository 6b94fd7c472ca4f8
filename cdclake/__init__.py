"""Spark-native change-data lakehouse: bronze landing, keyed snapshots, features, star joins."""
