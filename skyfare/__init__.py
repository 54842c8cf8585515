"""Trips × weather analytics on Spark."""
