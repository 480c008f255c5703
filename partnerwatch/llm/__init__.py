"""Training-data operators over documents, pages, embeddings and conversations.

Nothing else in the library imports this subpackage; ``queries`` registers one
query per operator and the corpus pipeline.
"""
