"""Spark-native engine for hourly series quality, features and forecasts."""
