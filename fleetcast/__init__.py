"""fleetcast: fleet telemetry analytics and capacity forecasting on Spark DataFrames."""

__version__ = "0.1.0"
