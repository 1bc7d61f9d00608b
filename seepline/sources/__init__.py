"""Landed files and tables in, uploads and map layers out."""
