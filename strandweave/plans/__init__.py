"""Registered queries: each applies an operator to tables, or to views of them in plain SQL, and has its oracle."""
