"""Booking-marketplace analytics on Spark DataFrames."""
