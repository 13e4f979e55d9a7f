"""Logistics marts and the DataFrame operators they are made of."""
