"""quarryweave: provenance-bound knowledge-graph analytics as Spark DataFrame plans."""
