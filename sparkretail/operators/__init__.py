"""DataFrame -> DataFrame operators: staging, marts, quality, metrics, drift, forecasting, serving."""
