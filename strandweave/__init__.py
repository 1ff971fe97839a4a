"""Catalogue reconciliation and corpus processing as Spark DataFrame operators."""
