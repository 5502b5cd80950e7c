"""Readers and row generators: message topics, envelope files, dimension tables, text logs."""
