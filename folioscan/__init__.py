"""Evidence analytics on Spark: sources, ledgers, grounding, histories, readings and wiki checks as DataFrame plans."""
