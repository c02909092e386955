"""Operators of a training-data pipeline. Nothing outside this folder imports them but the driver's entry."""
