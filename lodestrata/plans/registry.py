"""The modules whose queries are registered, and the query of the smoke check."""

from lodestrata.plans import entity_queries, graph_queries, nested_queries, stream_queries, text_queries

MODULES = [nested_queries, text_queries, entity_queries, graph_queries, stream_queries]
FLAGSHIP = "context_windows"
