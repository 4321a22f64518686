"""Training-data pipeline operators (documents, pages, embeddings).

Nothing else in the package imports this subpackage; ``queries`` holds the
registered queries and their SQL.
"""
