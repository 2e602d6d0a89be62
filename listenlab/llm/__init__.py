"""Operators for training-data pipelines over documents, pages and embeddings.

Each operator module has its own general interface on DataFrames;
``queries`` derives the registered queries from them. Nothing outside this
package imports it."""
