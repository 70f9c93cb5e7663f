"""Readers for raw measure and indicator files, sinks for result tables."""
