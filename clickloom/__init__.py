"""Behaviour analytics over a clickstream, written as Spark DataFrame operators."""
