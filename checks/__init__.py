"""Registered queries and the SQL each is compared with."""
