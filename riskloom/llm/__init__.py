"""Operators of a training-data pipeline.  Nothing else in riskloom imports this package."""
