"""Layered order analytics on PySpark: bronze ingest, silver facts, gold marts, forecasts."""
