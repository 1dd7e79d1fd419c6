"""Training-data operators over documents, embeddings and conversations, all as Spark jobs."""
