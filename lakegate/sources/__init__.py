"""Readers for documents, landed pages, processed tables and run manifests."""
