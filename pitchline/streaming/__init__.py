"""Stages over data that arrives in portions."""
