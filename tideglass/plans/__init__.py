"""The two jobs, and the queries over the driver's tables with their SQL counterparts."""
