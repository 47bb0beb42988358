"""Booking and fare analytics as Spark DataFrame functions."""
