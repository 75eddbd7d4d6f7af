"""Registered queries, their SQL counterparts and the documents they run on."""
