"""Operators for training-data pipelines over documents, pages, embeddings and
conversations.  Nothing outside this subpackage imports it; its queries are
registered by ``__spark_entry__`` when it can be imported."""
