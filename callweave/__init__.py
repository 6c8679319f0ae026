"""Conversation-transcript analytics on Spark."""
