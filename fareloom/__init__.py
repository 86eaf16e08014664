"""Booking-ledger analytics for a ride marketplace, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
