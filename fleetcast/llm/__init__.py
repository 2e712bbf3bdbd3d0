"""Training-data operators over documents, embeddings and conversations (nothing else in the library imports this)."""
