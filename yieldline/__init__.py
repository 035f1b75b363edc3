"""Hourly line KPIs (performance, availability, quality, yield, OEE) as Spark jobs."""
