"""Inventory reporting layer on PySpark: snapshot sync, property shredding, lookups, histories, views."""
