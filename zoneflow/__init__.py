"""zoneflow: zone-level movement analytics on Spark DataFrames.

Trips -> inflow/outflow events -> event-time tumbling windows (batch or Structured
Streaming) -> dense time x zone series -> graph supports and diffusion -> forecast ->
anomaly report. Every operator is a DataFrame -> DataFrame function.
"""
