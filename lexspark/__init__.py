"""Lexical search and corpus analytics on Spark DataFrames."""
