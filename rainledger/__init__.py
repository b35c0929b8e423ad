"""Daily lakehouse analytics on Spark: sources, sinks, operators and three ready plans."""
