"""Compositions: the table graph, the written pipeline and the reports."""
