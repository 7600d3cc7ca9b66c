"""Screening of marketplace listings of electrical products, as Spark DataFrame operators."""

__version__ = "0.1.0"
