"""Whole jobs: the library's commands and the registered queries."""
