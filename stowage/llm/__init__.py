"""Training-data operators. Nothing outside this subpackage imports it; queries are in ``llm.queries``."""
