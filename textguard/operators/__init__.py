"""Scans over text columns: rules, their composition, and the relational scans."""
