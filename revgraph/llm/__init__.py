"""Training-data operators: one module per operator, registered in ``revgraph.llm.queries``."""
