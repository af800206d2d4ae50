"""Retail, traffic and parcel analytics as Spark DataFrame jobs."""
