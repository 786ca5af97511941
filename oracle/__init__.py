"""SQL text checked against the Spark results; one module per part of the surface."""
