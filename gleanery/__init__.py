"""A PySpark-native engine that turns messy record tables into trustworthy analytical ones.

Sub-packages: ``sources`` (readers, contracts, sinks), ``functions`` (column functions),
``operators`` (relational and text operators), ``plans`` (queries and their SQL),
``streaming`` (stateful operators). The optional ``llm`` sub-package is imported by nothing here.
"""
