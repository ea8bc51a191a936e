"""Multi-tenant retail sync and fact engine on PySpark DataFrames."""
