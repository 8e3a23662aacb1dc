"""Composed plans: the hospital network's tables and marts, the layered run, and the queries on the test tables."""
