"""Queries on the sample layer and the SQL that checks them."""
