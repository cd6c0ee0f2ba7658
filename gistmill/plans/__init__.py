"""Stages that write shared tables, and the registered queries with their SQL."""
