"""Shelfmark: collects and links catalogue records with DataFrames."""
