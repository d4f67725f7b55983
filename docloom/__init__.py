"""docloom: document corpora to provenance-tracked knowledge graphs, as Spark DataFrame operators."""
