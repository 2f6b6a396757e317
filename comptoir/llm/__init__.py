"""Operators for training data: documents, pages, embeddings and conversations.

Nothing outside this package imports it. ``queries`` registers one query per
operator; each operator module has its own general interface.
"""
