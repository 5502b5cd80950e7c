"""Relational operators over transaction, node, edge and statistics frames."""
