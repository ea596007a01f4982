"""Listings of files, and loaders that turn files and tables into document rows."""
