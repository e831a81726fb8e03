"""Readers and writers for the record files the evaluation exchanges."""
