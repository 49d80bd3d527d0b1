"""Batch and streaming analytics for payment and subscription finance data on Spark."""
