"""sensorflow: room-sensor readings on Spark DataFrames and Structured Streaming.

Sources (``sources``), column functions (``functions``), operators over
DataFrames (``operators``), jobs and registered queries (``plans``) and
stream sinks and event-time operators (``streaming``). Every function takes
DataFrames or a session; none creates a session.
"""

__version__ = "0.1.0"
