"""Operational analytics for flights, disruptions, crew and data lineage, written as Spark jobs."""
