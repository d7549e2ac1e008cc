"""Catalogue-to-search and search-to-order jobs written as Spark DataFrame plans."""
