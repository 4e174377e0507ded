"""The relational work: staging, marts, quality checks, periods, KPIs, movers, trends, texts."""
