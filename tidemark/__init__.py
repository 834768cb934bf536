"""Time-series lakehouse on PySpark: bars, bronze/silver/gold tables, checks, tuning and streams."""
