"""Larder: quick-commerce retail analytics expressed as Spark DataFrame plans."""
