"""Retail batches proved, gated, published and served as generations, on Spark DataFrames."""
