"""Whole jobs: code-list extraction, the lake, the dimension load and the dated fact loads."""
