"""Registered queries, their input mapping and their SQL counterparts."""
