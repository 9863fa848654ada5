"""All queries: importing this module fills the registry."""

from quillmesh.plans import card_queries, function_queries, people_queries, queries, source_queries  # noqa: F401
