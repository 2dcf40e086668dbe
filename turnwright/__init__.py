"""Conversational-text analytics on Spark."""
