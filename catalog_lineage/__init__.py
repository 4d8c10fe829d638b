"""Governed catalogs and lineage graphs as Spark DataFrame programs."""
