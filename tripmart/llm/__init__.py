"""Training-data operators on document tables, and the queries that apply them."""
